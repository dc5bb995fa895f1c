"""Repeated long byte strings by longest-previous-factor arrays on suffixes.

A start is repeated if the ``length`` bytes from it also start anywhere else;
all bytes of such strings are removed (``keep="none"``), or all but those of the
first copy, the one with the smallest (doc_id, position) (``keep="first"``).

1. Every string of ``length`` bytes has an anchor, its k-byte gram of smallest
   hash, so equal strings have equal anchors at equal offsets.  Neighbouring
   starts with one anchor are a block: the bytes they cover together.
2. Blocks are counted by (anchor, content).  A content met twice is repeated as
   a whole, whatever the number of its copies; an anchor with one content met
   once is not repeated at all.
3. Only anchors with several contents, one of them met once, are left.  The
   suffixes of their contents, one copy each, are put in suffix order to depth
   ``length`` by prefix doubling (ranks of 8, 16, ... bytes), equal ones by
   position.  The ranks give the common prefix of neighbours; previous and next
   smaller positions in suffix order give each start its longest previous
   factor and where that lies.  A start is a later copy if its factor reaches
   ``length``, and the first copy if such a factor lies at it.
   Anchors with more contents than ``MANY`` are settled in Spark instead, by
   grouping the fingerprints of all their starts.

No string crosses documents: blocks are taken within one.

Defined cases: null is empty; texts shorter than ``length`` lose nothing;
repeated rows are copies of each other (with ``keep="first"`` rows that are
equal in doc_id and text count as one); rows of a null id work as any other; a
very long text is read whole; an empty table gives an empty result; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import arrow_task, materialize, mix64, prefix_hash, span_hash, steps, text_or_empty, utf8

LENGTH = 400
#: Bytes of an anchor.
GRAM = 100
#: Contents of an anchor that are sorted in one task, at most.
MANY = 2000
#: Bytes of contents that are sorted together, about.
SORT_BYTES = 1 << 20


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by blockwise running minima."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def blocks(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Of all texts: row, first start, number of starts, offset of the anchor from
    the first start, anchor hash, content hash of each block."""
    size = np.diff(offsets)
    if len(data) < length or size.max(initial=0) < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    prefix = prefix_hash(data)
    at = np.arange(len(data) - gram + 1)
    grams = span_hash(prefix, at, at + gram)
    least = window_minima(grams >> np.uint64(32) << np.uint64(32) | at.astype(np.uint64), length - gram + 1)
    starts = np.maximum(size - length + 1, 0)
    s = np.arange(starts.sum()) + np.repeat(offsets[:-1] - (np.cumsum(starts) - starts), starts)
    row = np.repeat(np.arange(len(size)), starts)
    anchor = (least[s] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(s), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(s)))
    lo, row, anchor = s[first], row[first], anchor[first]
    return row, lo - offsets[row], count, anchor - lo, grams[anchor], span_hash(prefix, lo, lo + count + length - 1)


def _find(length: int, gram: int):
    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in steps(offsets):
                row, lo, count, off, anchor, content = blocks(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], length, gram)
                where = pa.array(row + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(where), batch.column("th").take(where), pa.array(lo.astype(np.int32)), pa.array(count.astype(np.int32)),
                     pa.array(anchor.view(np.int64)), pa.array(mix64(content + off.astype(np.uint64)).view(np.int64))],
                    names=["doc_id", "th", "lo", "n", "anchor", "content"],
                )

    return run


def _extract(length: int):
    """The bytes of listed blocks of each text."""

    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, picks in enumerate(batch.column("picks").to_pylist()):
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[i : i + 1].take(pa.array([0] * len(picks))), batch.column("th")[i : i + 1].take(pa.array([0] * len(picks))),
                     pa.array([p["anchor"] for p in picks], pa.int64()), pa.array([p["copies"] for p in picks], pa.int64()), pa.array([p["kinds"] for p in picks], pa.int64()),
                     pa.array([p["lo"] for p in picks], pa.int32()), pa.array([raw[p["lo"] : p["lo"] + p["n"] + length - 1] for p in picks], pa.binary())],
                    names=["doc_id", "th", "anchor", "copies", "kinds", "lo", "bytes"],
                )

    return run


def suffix_ranks(data: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """Ranks of all suffixes by their first 8, 16, ... ``length`` bytes (equal
    ranks: equal bytes), by prefix doubling: (depth, ranks) of each step."""
    n = len(data)
    padded = np.append(data, np.zeros(length + 8, np.uint8)).astype(np.uint64)
    depth = min(8, length)
    key = np.zeros(n, np.uint64)
    for k in range(depth):
        key = key << np.uint64(8) | padded[k : k + n]
    rank = _dense(key)
    out = [(depth, rank.astype(np.uint32))]
    while depth < length:
        ahead = min(depth, length - depth)
        later = np.append(rank[ahead:], np.zeros(ahead, np.uint64))
        rank, depth = _dense(rank * np.uint64(n + 1) + later), depth + ahead
        out.append((depth, rank.astype(np.uint32)))
    return out


def common_prefixes(data: np.ndarray, ranks: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that the suffixes at a and at b have in common, to the depth of the
    ranks; the suffixes are that long."""
    most = ranks[-1][0]
    out = np.where(ranks[-1][1][a] == ranks[-1][1][b], most, 0)
    open_ = out == 0
    for depth, rank in ranks[-2::-1]:
        on = np.flatnonzero(open_)
        out[on] += np.where(rank[a[on] + out[on]] == rank[b[on] + out[on]], depth, 0)
    for _ in range(min(7, most - 1)):
        on = np.flatnonzero(open_)
        same = data[a[on] + out[on]] == data[b[on] + out[on]]
        out[on] += same
        open_[on[~same]] = False
    return out


def previous_smaller(values: np.ndarray, step: np.ndarray, rounds: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest place before it with a smaller value (-1: none),
    and the least of ``step`` on the way there; step[i] leads from i - 1 to i.

    Pointers jump together; what is still under way after ``rounds`` hops along
    finished pointers one by one, at most one hop for each place in all."""
    n = len(values)
    to, least = np.arange(n) - 1, step.copy()
    on = np.arange(n)
    for _ in range(rounds):
        on = on[to[on] >= 0]
        on = on[values[to[on]] > values[on]]
        if not len(on):
            return to, least
        by = to[on]
        least[on], to[on] = np.minimum(least[on], least[by]), to[by]
    for i in on.tolist():
        j, m = i - 1, step[i]
        while j >= 0 and values[j] > values[i]:
            m, j = min(m, least[j]), to[j]
        to[i], least[i] = j, m
    return to, least


def factor_lengths(data: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the suffixes at ``places`` (ascending, ``length`` bytes or more each): the
    length of the longest previous factor, to ``length`` at most, and the number
    of the place where it lies (-1: none)."""
    n = len(places)
    ranks = suffix_ranks(data, length)
    order = np.argsort(ranks[-1][1][places], kind="stable")  # suffix order; equal to the depth: by position
    at = places[order]
    step = np.zeros(n, np.int64)
    step[1:] = common_prefixes(data, ranks, at[:-1], at[1:])
    del ranks
    before, up = previous_smaller(order, step)
    # the same from the other end: the next smaller position
    after, down = previous_smaller(order[::-1], np.append(0, step[:0:-1])[:n])
    after, down = np.where(after < 0, -1, n - 1 - after)[::-1], down[::-1]
    up, down = np.where(before < 0, 0, up), np.where(after < 0, 0, down)
    own = np.maximum(up, down)
    factor, source = np.zeros(n, np.int64), np.full(n, -1)
    factor[order] = own
    source[order] = np.where(own == 0, -1, order[np.where(up >= down, before, after)])
    return factor, source


def _dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    ordered = key[order]
    rank = np.empty(len(key), np.uint64)
    rank[order] = np.cumsum(np.append(0, ordered[1:] != ordered[:-1])).astype(np.uint64)
    return rank


def previous_factors(contents: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all starts of contents in position order: content number, start, whether
    the longest previous factor, and whether any other one, reaches ``length``."""
    size = np.array([len(c) for c in contents])
    data = np.frombuffer(b"".join(contents), np.uint8)
    count = size - length + 1
    which = np.repeat(np.arange(len(size)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    factor, source = factor_lengths(data, np.repeat(np.cumsum(size) - size, count) + start, length)
    earlier = factor >= length
    # a first copy: the second one's factor lies there
    other = earlier.copy()
    other[source[earlier]] = True
    return which, start, earlier, other


def _runs(which: np.ndarray, start: np.ndarray, marked: np.ndarray, n: int) -> list[list[tuple[int, int]]]:
    """Marked runs of starts of each content: (first, number)."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    on = np.flatnonzero(marked)
    if len(on):
        new = np.append(True, (on[1:] != on[:-1] + 1) | (which[on[1:]] != which[on[:-1]]))
        first = np.flatnonzero(new)
        for a, m in zip(on[first].tolist(), np.diff(np.append(first, len(on))).tolist()):
            out[which[a]].append((int(start[a]), m))
    return out


def _sort_suffixes(length: int, keep: str):
    """Over rows ordered by anchor: marked runs of each content, whole anchors together."""

    def settle(rows: list[dict]) -> pa.RecordBatch:
        # position order: by document, then by place
        rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"], r["th"], r["lo"]) if r["doc_id"] is not None else (True, 0, r["th"], r["lo"]))
        which, start, earlier, other = previous_factors([r["bytes"] for r in rows], length)
        found = _runs(which, start, earlier if keep == "first" else other, len(rows))
        flat = [(r["doc_id"], r["th"], r["lo"] + a, m) for r, runs in zip(rows, found) if keep == "first" or r["copies"] == 1 for a, m in runs]
        ids, ths, los, ns = zip(*flat) if flat else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(ids, kind[0]), pa.array(ths, pa.int64()), pa.array(los, pa.int32()), pa.array(ns, pa.int32())], names=["doc_id", "th", "lo", "n"])

    kind: list = [None]

    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        total = 0
        for batch in batches:
            kind[0] = batch.schema.field("doc_id").type
            for row in batch.to_pylist():
                if total >= SORT_BYTES and row["anchor"] != held[-1]["anchor"]:
                    yield settle(held)
                    held, total = [], 0
                held.append(row)
                total += len(row["bytes"])
        if held:
            yield settle(held)

    return run


def _fingerprint_starts(length: int):
    """One row for each start of each content."""

    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, raw in enumerate(batch.column("bytes").to_pylist()):
                data = np.frombuffer(raw, np.uint8)
                at = np.arange(len(data) - length + 1)
                h = span_hash(prefix_hash(data), at, at + length)
                again = pa.array(np.full(len(at), k))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(again) for c in ("doc_id", "th", "anchor", "copies")), pa.array((batch.column("lo")[k].as_py() + at).astype(np.int32)), pa.array(h.view(np.int64))],
                    names=["doc_id", "th", "anchor", "copies", "lo", "h"],
                )

    return run


def repeated(docs: DataFrame, length: int = LENGTH, keep: str = "none", gram: int | None = None) -> DataFrame:
    """Runs of starts to remove: doc_id, th (hash of the text), lo, n; a run covers
    the bytes from lo to lo + n + length - 1."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep must be 'none' or 'first', not {keep!r}")
    gram = gram or min(GRAM, length)
    keyed = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("th"), text_or_empty().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = keyed if keep == "none" else keyed.dropDuplicates(["doc_id", "th"])
    found = materialize(found.mapInArrow(_find(length, gram), f"doc_id {kind}, th bigint, lo int, n int, anchor bigint, content bigint"), "suffix-blocks")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "lo", "n")
    contents = found.groupBy("anchor", "content").agg(F.count("*").alias("copies"), F.min(at).alias("at"))
    # an anchor met in one content that is met once has no copy: it goes here
    anchors = contents.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("copies").alias("least")).where("kinds > 1 or least > 1")
    contents = materialize(contents.join(anchors, "anchor"), "suffix-contents")
    whole = found.join(contents.where("copies > 1").select("anchor", "content", "at"), ["anchor", "content"])
    if keep == "first":
        whole = whole.where(~(F.col("doc_id").eqNullSafe(F.col("at.doc_id")) & (F.col("th") == F.col("at.th")) & (F.col("lo") == F.col("at.lo"))))
    whole = whole.select("doc_id", "th", "lo", "n")
    open_ = contents.where("kinds > 1" + (" and least = 1" if keep == "none" else ""))
    picks = (
        open_.select("at.doc_id", "at.th", F.struct("anchor", "copies", "kinds", "at.lo", "at.n").alias("pick"))
        .groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg(F.collect_list("pick").alias("picks"))
    )
    one = keyed.join(picks, keyed.doc_id.eqNullSafe(picks._id) & (keyed.th == picks._th)).select("doc_id", "th", "text", "picks")
    shape = f"doc_id {kind}, th bigint, anchor bigint, copies bigint, kinds bigint, lo int, bytes binary"
    raw = materialize(one.mapInArrow(_extract(length), shape), "suffix-bytes").dropDuplicates(["doc_id", "th", "anchor", "lo"])
    few = raw.where(F.col("kinds") <= MANY)
    sorted_ = few.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sort_suffixes(length, keep), f"doc_id {kind}, th bigint, lo int, n int")
    starts = raw.where(F.col("kinds") > MANY).mapInArrow(_fingerprint_starts(length), f"doc_id {kind}, th bigint, anchor bigint, copies bigint, lo int, h bigint")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "lo")
    grouped = starts.groupBy("anchor", "h").agg(F.count("*").alias("times"), F.min(at).alias("at")).where("times > 1")
    later = starts.join(grouped, ["anchor", "h"])
    later = later.where("copies = 1") if keep == "none" else later.where(~(F.col("doc_id").eqNullSafe(F.col("at.doc_id")) & (F.col("th") == F.col("at.th")) & (F.col("lo") == F.col("at.lo"))))
    return whole.union(sorted_).union(later.select("doc_id", "th", "lo", F.lit(1).alias("n")))


def _cut(length: int):
    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            removed, n_spans, kept, digest = [], [], [], []
            for i, runs in enumerate(batch.column("runs").to_pylist()):
                raw = data[offsets[i] : offsets[i + 1]]
                if runs:
                    change = np.zeros(len(raw) + 1, np.int64)
                    np.add.at(change, [r["lo"] for r in runs], 1)
                    np.add.at(change, [r["lo"] + r["n"] + length - 1 for r in runs], -1)
                    gone = np.cumsum(change[:-1]) > 0
                    removed.append(int(gone.sum()))
                    n_spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                    raw = raw[~gone]
                else:
                    removed.append(0)
                    n_spans.append(0)
                kept.append(raw.tobytes())
                digest.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary()), pa.array(digest, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "none") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes, which may
    break a character) and kept_sha256 of each document."""
    runs = repeated(docs, length, keep)
    runs = runs.groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg(F.collect_list(F.struct("lo", "n")).alias("runs"))
    keyed = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("th"), text_or_empty().alias("text"))
    joined = keyed.join(runs, keyed.doc_id.eqNullSafe(runs._id) & (keyed.th == runs._th), "left").select("doc_id", "text", "runs")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(_cut(length), f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string")


#: The rows of ``remove_repeats`` over documents (less ``kept``), by the 128-bit digests of all starts.
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
starts AS (SELECT rid, b, unnest(range(octet_length(b) - {LENGTH - 1})) AS p FROM d),
digests AS (SELECT rid, p, md5_number(b[p + 1 : p + {LENGTH}]) AS h FROM starts),
met AS (SELECT h FROM digests GROUP BY h HAVING count(*) > 1),
marked AS (SELECT rid, p FROM digests SEMI JOIN met USING (h)),
opened AS (SELECT rid, p, CASE WHEN p - lag(p) OVER (PARTITION BY rid ORDER BY p) <= {LENGTH} THEN 0 ELSE 1 END AS new FROM marked),
numbered AS (SELECT rid, p, sum(new) OVER (PARTITION BY rid ORDER BY p ROWS UNBOUNDED PRECEDING) AS k FROM opened),
spans AS (SELECT rid, min(p) AS lo, max(p) + {LENGTH} AS hi FROM numbered GROUP BY rid, k),
gaps AS (
  SELECT rid, coalesce(lag(hi) OVER (PARTITION BY rid ORDER BY lo), 0) AS a, lo AS z FROM spans
  UNION ALL SELECT rid, coalesce(max(hi), 0), max(octet_length(b)) FROM d LEFT JOIN spans USING (rid) GROUP BY rid
),
kept AS (SELECT rid, unhex(string_agg(hex(b[a + 1 : z]), '' ORDER BY a)) AS k FROM gaps JOIN d USING (rid) GROUP BY rid),
counted AS (SELECT rid, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM spans GROUP BY rid)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(k) AS kept_sha256
FROM d JOIN kept USING (rid) LEFT JOIN counted USING (rid)
"""
