from __future__ import annotations

import hashlib
import random
import re

from tillroll.llm import pii
from llm_fixtures import docs, edge, empty, llm  # noqa: F401


def luhn(d):
    twice = (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2 for c in reversed(d))
    return 14 <= len(d) <= 19 and sum(t if k % 2 else int(c) for k, (c, t) in enumerate(zip(reversed(d), twice))) % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m)


#: The kinds as specified.
BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
]


def base(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, rx, ok) in enumerate(BASE) for m in re.finditer(rx, text or "") if ok(m[0])]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def check(rows, got):
    assert len(rows) == len(got)
    want = {(i, t): base(t) for i, t in rows}
    for (i, t), r in zip(sorted(rows, key=str), sorted(got, key=lambda r: str((r.doc_id, r.text)))):
        b = want[(i, t)]
        assert r.base_sha256 == hashlib.sha256(",".join(b).encode()).hexdigest(), (t, b, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k + ":") for x in b) for k, _, _ in BASE]
        assert set(b) <= set(r.spans.split(","))


def test_base_against_brute_force(docs):
    rng = random.Random(3)
    card = "4111 1111 1111 1111"
    rows = [(i, "".join(rng.choice(["0", "1", "25", "9", ".", "..", "@", "+", "-", " ", "(", ")", "a", "b%", "_", "é", card]) for _ in range(rng.randint(0, 120)))) for i in range(1500)]
    rows += [(5000, "a@b.c%d@e.f 1.2.3.4.5.6.7.8 000.0.0.255 00256.1.1.1 4111-1111-1111-1111-2 +1 (523) 555-1055."), (5001, None), (5002, ""), (5003, "5 " * 3000), (5004, "a." * 20000 + "@x.y"), (5005, "1" * 20000)]
    got = pii.report(docs(rows)).join(docs(rows), "doc_id").collect()
    check(rows, got)


def test_contexts_find_unseen_identifiers(docs):
    rows = [(i, f"the secret mailbox is user{i}@site{i}.org for good") for i in range(6)] + [(100, "the secret mailbox is bob@localhost for good"), (101, "the secret mailbox is x1 for good"), (102, "chapter 2023 of bob@localhost")]
    got = {r.doc_id: r for r in pii.report(docs(rows)).collect()}
    assert got[100].spans == "email:22:35" and got[100].n_added == 1 and got[100].n_email == 0
    assert got[101].n_added == 0 and got[102].n_added == 0


def test_copies_do_not_make_a_pattern(docs):
    rows = [(i, "the secret mailbox is user@site.org for good") for i in range(9)] + [(100, "the secret mailbox is bob@localhost for good")]
    assert all(r.n_added == 0 for r in pii.report(docs(rows)).collect())


def test_redact(docs, edge, empty):
    rows = [(1, "mail a@b.cd or +1 (523) 555-1055!", "k"), (1, "mail a@b.cd or +1 (523) 555-1055!", "k"), (2, None, "k"), (None, "x@1.2.3.4", "k"), (3, "é☃ 1.2.3.4 é", "k")]
    got = pii.redact(docs(rows, "doc_id long, text string, th string")).collect()
    assert sorted(((r.doc_id, r.text, r.th) for r in got), key=str) == sorted([(1, "mail [EMAIL] or [PHONE]!", "k")] * 2 + [(2, None, "k"), (None, "[EMAIL]", "k"), (3, "é☃ [IP] é", "k")], key=str)
    assert pii.report(edge).count() == edge.count()
    assert pii.report(empty).count() == 0


def test_main_path_is_native(docs):
    plan = pii.report(docs([(1, "a@b.cd")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_grouped_numbers_are_found_whole(docs):
    seeds = [(i, f"ring me at +1 (523) 555-10{i}5 any day") for i in range(6)]
    rows = seeds + [(100, "ring me at 555 867 5309 any day"), (101, "ring me at (555) 123-4567 any day"), (102, "ring me at 12 any day"), (103, "ring me at " + "5 " * 40 + "any day"), (104, "pages 555 867 5309 of it")]
    got = {r.doc_id: r for r in pii.report(docs(rows)).collect()}
    assert got[100].spans == "phone:11:23" and got[101].spans == "phone:11:25"
    assert all(got[i].n_added == 0 for i in (102, 103, 104))


def test_context_words_are_whole(docs):
    end = "w" * 90
    seeds = [(i, f"note x{end} user{i}@site{i}.org y{end}") for i in range(6)] + [(20 + i, f"room 12 user{i}@host{i}.org here") for i in range(6)]
    rows = seeds + [(100, f"note x{end} bob@localhost y{end}"), (101, f"note z{end} bob@localhost y{end}"), (102, "room 12 amy@localhost here"), (103, "room 13 amy@localhost there")]
    got = {r.doc_id: r for r in pii.report(docs(rows)).collect()}
    assert [got[i].n_added for i in (100, 101, 102, 103)] == [1, 0, 1, 0]


def brute_words(text, lo, hi):
    """The words around a span, lower-cased."""
    before, after = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text[:lo]), re.findall(r"[^\x20\x09-\x0D]+", text[hi:])
    return "".join(before[-2:]).rstrip(" \n\t").lower() if len(before) > 1 else "", before[-1].strip().lower() if before else "", after[0].lower() if after else ""


def brute_discover(rows):
    """Scores of patterns and values in plain loops: rows of (kind, value, two, last, following)."""
    edges = {}
    for kind, value, two, last, following in rows:
        for pattern in ([f"L {two}"] if two else []) + ([f"A {last} _ {following}"] if last and following else []):
            seed = edges.setdefault(pattern, {}).get(value)
            edges[pattern][value] = min(filter(None, (seed, kind)), default=None)
    found, confident = {}, {}
    for _ in range(pii.ROUNDS):
        doubts = {}
        for (pattern, kind), c in confident.items():
            for value, seed in edges[pattern].items():
                if seed is None:
                    doubts[value, kind] = doubts.get((value, kind), 1.0) * max(1e-9, 1 - c)
        found, confident = {k: 1 - d for k, d in doubts.items()}, {}
        for pattern, values in edges.items():
            seeds = [s for s in values.values() if s]
            for kind in set(seeds):
                if seeds.count(kind) >= pii.SEEDS:
                    c = sum((s == kind) if s else found.get((v, kind), 0.0) for v, s in values.items()) / len(values)
                    if c >= 0.75 * pii.CONFIDENT:
                        confident[pattern, kind] = c
    return {k: c for k, c in confident.items() if c >= pii.CONFIDENT}


def test_scores_against_brute_force(docs):
    rng = random.Random(8)
    lead, tail = ["call", "the  mailbox", "my box is", "id", "x 7 at"], ["now", "or", "ok\n"]
    value = [lambda: f"u{rng.randint(0, 30)}@s.org", lambda: f"+1 (523) 555-1{rng.randint(100, 130)}", lambda: f"b{rng.randint(0, 5)}@local", lambda: f"555 867 53{rng.randint(10, 14)}", lambda: f"c{rng.randint(0, 3)}"]
    rows = []
    for i in range(400):
        text = ""
        for _ in range(rng.randint(1, 4)):
            k = rng.randrange(5)
            v = value[rng.choice([0, 0, 0, 0, 0, 0, 0, 2, 4] if k in (1, 2) else [1, 1, 1, 1, 1, 1, 1, 3, 4] if k == 0 else range(5))]
            text += f"{lead[k]} {v()} {rng.choice(tail)} "
        rows.append((i, text))
    text = dict(rows)
    met = pii.materialize(pii.mentions(docs(rows)), "t")
    plain = [r for r in met.collect()]
    for r in plain:
        assert text[r.doc_id][r.lo : r.hi] == r.value
        assert (r.two, r.last, r.following) == brute_words(text[r.doc_id], r.lo, r.hi), (r, text[r.doc_id])
    sure = brute_discover([(r.kind, r.value, r.two, r.last, r.following) for r in plain])
    want = {}
    for r in plain:
        n = len(digits(r.value))
        looks = {"email": "@" in r.value and len(r.value) >= 5, "ip": False, "card": n >= 12, "phone": n >= 7}
        for pattern in (f"L {r.two}", f"A {r.last} _ {r.following}"):
            for kind, ok in looks.items():
                if r.kind is None and ok and (pattern, kind) in sure:
                    want[r.doc_id, r.lo, r.hi] = max(want.get((r.doc_id, r.lo, r.hi), (0, "")), (sure[pattern, kind], kind))
    want = {(*k, v[1]) for k, v in want.items() if not any(o[0] == k[0] and o != k and o[1] <= k[1] and k[2] <= o[2] for o in want)}
    got = {(r.doc_id, r.lo, r.hi, r.kind) for r in pii.discover(met).collect()}
    assert got == want and len(want) > 10
