"""Toxicity by a support vector machine on a gap-weighted subsequence kernel with Nyström landmarks.

Two strings are alike by the letter triples they share: a triple weighs
``DECAY`` to the power of the letters it skips, within ``WIDTH`` letters, and the
kernel is the cosine of two strings' triple weights, to the power ``POWER``.  Signs, digits and other
characters between letters take no part, so ``i.d-i0o_t`` reads as ``idiot``; an inserted letter
leaves most triples with a gap.

A text is the set of its strings: its words, one-letter words in a row joined
(``i d i o t``; also without the first or the last of them), and, of words of over ``LONGEST`` letters, overlapping windows of
that length.  Its likeness to a landmark is that of its most similar string.
Landmarks are strings that are met more in toxic training texts than in others,
each unlike those before it, and some frequent strings of the others.  The Nyström map
(the likenesses times the inverse root of the landmarks' own kernel) makes the
features; a linear machine with squared hinge loss is fitted on them by Newton
steps, and a logistic curve over its margins gives the score.

Fitting takes at most ``MOST`` labelled texts, those with the smallest id hashes.
Spark counts their strings and brings ``CANDIDATES`` of them and one row of
features for each text to the driver; scoring reads every text whole, with the
model broadcast (a few MB).

Defined cases: null and empty texts and texts without a letter have no string
and get the score of no likeness at all; very long texts are steps of their
own; without training rows of both labels, or strings met ``MET`` times, every score is the share of label 1
(0.5 without rows); repeated rows count again; ties between landmarks go by their
text; an empty table gives no row; columns named score or predicted are replaced,
others kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import _SPACE, arrow_task, extended, id_remainder, materialize, mix64, powers, steps, utf8, without

#: Labelled texts that a fit may take.
MOST = 20_000
#: Strings looked at as landmarks, landmarks of toxic texts, and of others.
CANDIDATES, TOXIC, OTHER = 1500, 144, 16
#: Texts that a landmark is met in, at least; likeness to an earlier landmark, at most.
MET, APART = 4, 0.8
#: Weight of a skipped letter, letters that a triple spans at most, letters of a string at most.
DECAY, WIDTH, LONGEST = 0.6, 5, 24
#: Power of the cosine, which parts like strings from those that share some syllables.
POWER = 3
#: Bytes of text of one step.
STEP = 1 << 20
#: Score from which a text is predicted toxic.
THRESHOLD = 0.7
_BITS = 15

# a-z and A-Z are 0 to 25; other characters go by their last byte to 26 to 31; first bytes of those, digits and signs are none
_symbol = np.full(256, -1, np.int8)
_symbol[65:91] = _symbol[97:123] = np.arange(26)
_symbol[128:192] = 26 + np.arange(64) % 6
_OFFSETS = [(a, b) for b in range(2, WIDTH) for a in range(1, b)]


class Strings:
    """The distinct strings of some texts: their letters (``symbols`` from ``starts``,
    ``sizes`` many), an example's place in the text, and, for each occurrence in row order, ``row`` and ``own``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        symbol = _symbol[data]
        at = np.flatnonzero(symbol >= 0)
        symbols = symbol[at].astype(np.int64)
        gap = np.append(0, np.cumsum(_SPACE[data]))[at]
        row = np.searchsorted(offsets, at, "right") - 1
        new = np.ones(len(at), bool)
        new[1:] = (gap[1:] != gap[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
        # one-letter words in a row, at most two spaces apart, are one string
        single = size == 1
        joined = np.zeros(len(first), bool)
        if len(first) > 1:
            joined[1:] = single[1:] & single[:-1] & (row[first[1:]] == row[first[:-1]]) & (gap[first[1:]] - gap[first[:-1]] <= 2)
        run = np.append(joined[1:], False)[~joined] if len(first) else joined
        first = first[~joined]
        size = np.diff(np.append(first, len(at)))
        # also without the first or the last letter, which may be words of their own
        first = np.concatenate([first, first[run] + 1, first[run]])
        size = np.concatenate([size, size[run] - 1, size[run] - 1])
        order = np.argsort(first, kind="stable")
        first, size = first[order], size[order]
        # long ones as windows
        windows = np.where(size > LONGEST, -(-(size - LONGEST) // (LONGEST // 2)) + 1, 1)
        nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        starts = np.repeat(first, windows) + nth * (LONGEST // 2)
        sizes = np.minimum(np.repeat(first + size, windows) - starts, LONGEST)
        prefix = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(mix64(symbols.astype(np.uint64)) * powers(max(len(symbols), 1))[0][: len(symbols)], out=prefix[1:])
        key = mix64((prefix[starts + sizes] - prefix[starts]) * powers(len(prefix))[1][starts] + sizes.astype(np.uint64))
        _, example, own = np.unique(key, return_index=True, return_inverse=True)
        self.symbols, self.starts, self.sizes = symbols, starts[example], sizes[example]
        self.row, self.own = (row[starts] if len(starts) else np.zeros(0, np.int64)), own.reshape(-1)
        self.lo = at[self.starts] if len(at) else self.starts
        self.hi = at[self.starts + self.sizes - 1] + 1 if len(at) else self.starts

    def texts(self) -> list[str]:
        """Letters of the distinct strings, as text: a-z, and 0 to 5 for other characters."""
        letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz012345", np.uint8)[self.symbols]
        return [letters[a : a + n].tobytes().decode() for a, n in zip(self.starts.tolist(), self.sizes.tolist())]


def triples(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, triple and summed weight, each pair once, by string; every string's weights have norm 1."""
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    which = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(sizes, sizes) - at  # letters from here on
    place = np.repeat(starts, sizes) + at
    keys, weights = [], []
    for a, b in _OFFSETS:
        on = left > b
        p = place[on]
        keys.append(which[on] << _BITS | symbols[p] << 10 | symbols[p + a] << 5 | symbols[p + b])
        weights.append(np.full(len(p), DECAY ** (b - 2)))
    # strings of one or two letters: the letters alone, in places of their own
    short = (sizes < 3) & (sizes > 0)
    s = starts[short]
    keys.append(np.flatnonzero(short) << _BITS | symbols[s] << 10 | symbols[s + sizes[short] - 1] << 5 | 31)
    weights.append(np.ones(len(s)))
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    if not len(key):
        return key, key, weight
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    weight, key = np.add.reduceat(weight, new), key[new]
    which = key >> _BITS
    norm = np.sqrt(np.bincount(which, weights=weight**2, minlength=len(sizes)))
    return which, key & ((1 << _BITS) - 1), weight / norm[which]


def spell(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, starts and sizes of strings given as ``Strings.texts`` gives them."""
    code = np.full(256, 0, np.int64)
    code[np.frombuffer(b"abcdefghijklmnopqrstuvwxyz012345", np.uint8)] = np.arange(32)
    size = np.array([len(t) for t in texts], np.int64)
    return code[np.frombuffer("".join(texts).encode(), np.uint8)], np.cumsum(size) - size, size


class Postings:
    """The landmarks of each triple with their weights, triple after triple."""

    def __init__(self, texts: list[str]):
        which, triple, weight = triples(*spell(texts))
        order = np.argsort(triple, kind="stable")
        self.n, self.landmark, self.weight = max(len(texts), 1), which[order], weight[order]
        self.first = np.searchsorted(triple[order], np.arange((1 << _BITS) + 1))


def kernel(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, landmarks: Postings) -> np.ndarray:
    """Likeness of each string to each landmark."""
    out = np.zeros((len(sizes), landmarks.n), np.float32)
    for i in range(0, len(sizes), 1 << 13):
        part = slice(i, i + (1 << 13))
        which, triple, weight = triples(symbols, starts[part], sizes[part])
        held = landmarks.first[triple + 1] - landmarks.first[triple]
        on = held > 0
        which, triple, weight, held = which[on], triple[on], weight[on], held[on]
        at = np.arange(int(held.sum())) - np.repeat(np.cumsum(held) - held, held) + np.repeat(landmarks.first[triple], held)
        key = np.repeat(which * landmarks.n, held) + landmarks.landmark[at]
        cosine = np.bincount(key, weights=np.repeat(weight, held) * landmarks.weight[at], minlength=len(sizes[part]) * landmarks.n)
        out[part] = np.minimum(cosine, 1.0).reshape(-1, landmarks.n) ** POWER
    return out


def likeness(data: np.ndarray, offsets: np.ndarray, landmarks: Postings) -> np.ndarray:
    """Of each text, the likeness of its most similar string to each landmark."""
    out = np.zeros((len(offsets) - 1, landmarks.n), np.float32)
    if len(data):
        s = Strings(data, offsets)
        if len(s.row):
            k = kernel(s.symbols, s.starts, s.sizes, landmarks)
            pair = np.unique(s.row << 32 | s.own)
            row, own = pair >> 32, pair & 0xFFFFFFFF
            new = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            for i in range(0, len(new), 256):  # texts at a time
                lo, hi = new[i], new[i + 256] if i + 256 < len(new) else len(row)
                out[row[new[i : i + 256]]] = np.maximum.reduceat(k[own[lo:hi]], new[i : i + 256] - lo, axis=0)
    return out


# --------------------------------------------------------------------- fit


class Model:
    def __init__(self, landmarks: list[str], weights: np.ndarray, curve: tuple[float, float]):
        self.landmarks, self.weights, self.curve = landmarks, weights, curve

    def score(self, z: np.ndarray) -> np.ndarray:
        margin = z @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * margin + self.curve[1], -50, 50)))


def _strings_of():
    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in steps(offsets, STEP):
                s = Strings(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                own = np.unique(s.row << 32 | s.own) if len(s.row) else np.zeros(0, np.int64)
                label = batch.column("label")[i:j].to_numpy(zero_copy_only=False)[own >> 32].astype(np.int64)
                n = len(s.sizes)
                toxic = np.bincount(own & 0xFFFFFFFF, weights=label, minlength=n).astype(np.int64)
                met = np.bincount(own & 0xFFFFFFFF, minlength=n).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(s.texts(), pa.string()), pa.array(toxic), pa.array(met - toxic)], names=["string", "toxic", "other"])

    return run


def _features(shared):
    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        landmarks = Postings(shared.value.landmarks)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in steps(offsets, STEP):
                z = likeness(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], landmarks)
                yield pa.RecordBatch.from_arrays([batch.column("label")[i:j], pa.array([x.tobytes() for x in z], pa.binary())], names=["label", "z"])

    return run


def choose(strings: list[str], most: int, apart: float = APART) -> list[str]:
    """Of strings in order of merit, those unlike all chosen before."""
    if not strings:
        return []
    alike = kernel(*spell(strings), Postings(strings)) ** (1 / POWER)
    out: list[int] = []
    for k in range(len(strings)):
        if len(out) < most and (not out or alike[k, out].max() <= apart):
            out.append(k)
    return [strings[k] for k in out]


def machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, decay: float = 0.5, rounds: int = 30) -> np.ndarray:
    """Weights and offset of a linear machine with squared hinge loss, by Newton steps
    on the rows within the margin; y is -1 or 1."""
    a = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.append(np.full(x.shape[1], decay), 1e-6)
    w = np.zeros(a.shape[1])
    inside = np.ones(len(y), bool)
    for _ in range(rounds):
        held, c = a[inside], cost[inside]
        w = np.linalg.solve(held.T @ (held * c[:, None]) + np.diag(penalty), held.T @ (c * y[inside]))
        now = y * (a @ w) < 1
        if (now == inside).all():
            break
        inside = now
    return w


def curve(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve of label 1 over the margin."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a = np.column_stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), a.T @ (p - target) + 1e-3 * (w - [1.0, 0.0]))
        w = w - step / max(1.0, np.abs(step).max())
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST, landmarks: int = TOXIC, others: int = OTHER) -> Model:
    """Fit on the texts of docs (doc_id, text) that labels (doc_id, label) rates 0 or
    1; other labels take no part."""
    spark = docs.sparkSession
    known = labels.where("label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))
    picked = known.orderBy(F.xxhash64("doc_id", F.lit(23)), "doc_id", "label").limit(most)
    # ids and labels of at most ``most`` texts; the texts stay where they are
    sample = materialize(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "label"), "toxicity-sample")
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    share = 0.5 if not n1 + n0 else n1 / (n1 + n0)
    constant = Model([], np.zeros(2), (0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6)))))
    if not n1 or not n0:
        return constant
    met = sample.mapInArrow(_strings_of(), "string string, toxic bigint, other bigint").groupBy("string").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    met = met.where((F.col("toxic") + F.col("other") >= MET) & (F.length("string") > 2)).cache()
    gain = F.col("toxic") * F.log((F.col("toxic") + 0.5) / (n1 + 1) / ((F.col("other") + 0.5) / (n0 + 1)))
    toxic = [r["string"] for r in met.orderBy(gain.desc(), "string").limit(CANDIDATES).collect()]
    usual = [r["string"] for r in met.orderBy(F.col("other").desc(), "string").limit(4 * others).collect()]
    met.unpersist()
    chosen = choose(toxic, landmarks)
    chosen += [s for s in choose(usual, others) if s not in chosen]
    if not chosen:
        return constant
    shared = spark.sparkContext.broadcast(Model(chosen, np.zeros(len(chosen) + 1), (1.0, 0.0)))
    got = sample.mapInArrow(_features(shared), "label int, z binary").toArrow()
    z = np.frombuffer(b"".join(got.column("z").to_pylist()), np.float32).reshape(-1, max(len(chosen), 1)).astype(float)
    y = got.column("label").to_numpy()
    values, vectors = np.linalg.eigh(kernel(*spell(chosen), Postings(chosen)).astype(float))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-2))) @ vectors.T  # the Nyström map
    x = z @ root
    mean = x.mean(axis=0)
    cost = np.where(y == 1, len(y) / (2 * n1), len(y) / (2 * n0))  # both labels weigh the same
    w = machine(x - mean, np.where(y == 1, 1.0, -1.0), cost)
    w = np.append(root @ w[:-1], w[-1] - mean @ w[:-1])
    return Model(chosen, w, curve(z @ w[:-1] + w[-1], y))


# ------------------------------------------------------------------- score


def _score(shared, threshold: float):
    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        landmarks = Postings(shared.value.landmarks)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            out = [np.zeros(0)]
            for i, j in steps(offsets, STEP):
                z = likeness(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], landmarks)
                out.append(shared.value.score(z.astype(float)))
            got = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got), pa.array((got >= threshold).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"])

    return run


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of docs (text among them) with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = without(docs, "score", "predicted")
    return docs.mapInArrow(_score(shared, threshold), extended(docs, "score double, predicted int"))


def held_out(col: str = "doc_id"):
    return id_remainder(col, 3) == 1
