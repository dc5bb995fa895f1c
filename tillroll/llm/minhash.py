"""Near-duplicate classes by BagMinHash signatures, banding and exact verification.

A text is the multiset of its five-word shingles (one shingle of all words if
it has fewer).  Each (shingle, weight interval) owns a Poisson process; weights
are discretised on the dyadic intervals [0,1), [1,2), [2,4), ..., and points of
the last interval above a text's weight are thinned out by their own weight
coordinate.  Position i of a signature is the first point that falls to it, so
two texts agree there with the probability of their weighted Jaccard similarity
sum(min)/sum(max), without bias.  Arrival times beyond the last one needed are
never drawn.

Signatures are cut into bands.  Texts that share a band are candidates:

1. texts with equal shingle multisets are one node, whatever their number;
2. each node is verified against the pivot of each of its buckets: the node
   that meets most others, so the centre of a family of copies;
3. what may still be linked within a bucket of several classes is found from
   the overlaps with the pivot without losing a pair (``_cross``) and verified.

Verification counts the overlap of the shingle multisets of the whole texts.
Classes are the connected components of the verified links.

Defined cases: null, empty or all-blank texts have no shingle and are a class
each (by doc_id); rows of equal text share a class; null ids are allowed and
never chosen as a class id unless the class has no other; extra columns are
ignored by ``classes`` and kept by ``keep_one``; a very long text is read whole;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import arrow_task, components, groups, materialize, mix64, packed, prefix_hash, span_hash, steps, text_or_empty, utf8, word_bounds

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
#: Signature positions: a pair at similarity 0.8 shares no band with probability 7e-5.
POSITIONS = BANDS * ROWS

_MUL = mix64(np.arange(64, dtype=np.uint64) + np.uint64(77)) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row: row number, hash, count."""
    starts, ends, at = word_bounds(data, offsets)
    words = span_hash(prefix_hash(data), starts, ends)
    n_words = np.diff(at)
    count = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    row = np.repeat(np.arange(len(n_words)), count)
    first = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(at[:-1], count)
    padded = np.append(words, np.zeros(size, np.uint64))
    h = np.zeros(len(first), np.uint64)
    short = np.repeat(n_words, count)
    for k in range(size):
        h += np.where(k < short, padded[first + k], np.uint64(0)) * _MUL[k]
    h = mix64(h)
    order, runs, weight = groups(mix64(h ^ (row.astype(np.uint64) * _MUL[size])))
    return row[order[runs]], h[order[runs]], weight


def bag_minhash(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n_rows: int, positions: int = POSITIONS) -> np.ndarray:
    """Weighted-Jaccard signatures (n_rows x positions arrival times) of multisets
    given as (row, element hash, integer weight >= 1); inf where a row is empty."""
    total = np.bincount(row, weights=weight, minlength=n_rows)
    sig = np.full((n_rows, positions), np.inf)
    todo, slack = total > 0, 6.0
    while todo.any():
        use = todo[row]
        _arrivals(row[use], element[use], weight[use], (np.log(positions) + slack) / np.maximum(total, 1), sig)
        # a position without a point before the limit: draw further
        todo = todo & np.isinf(sig).any(axis=1)
        slack *= 2
    return sig


def _arrivals(row: np.ndarray, element: np.ndarray, weight: np.ndarray, limit: np.ndarray, sig: np.ndarray) -> None:
    positions = sig.shape[1]
    # the dyadic intervals that start below the weight: 0, 1, 2, 4, ...
    n_parts = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    which = np.repeat(np.arange(len(row)), n_parts)
    part = np.arange(len(which)) - np.repeat(np.cumsum(n_parts) - n_parts, n_parts)
    low = np.where(part == 0, 0, 2.0 ** (part - 1))
    length = np.where(part == 0, 1, low)
    seed = mix64(element[which] + part.astype(np.uint64) * _MUL[40])
    top, doc = weight[which].astype(np.float64), row[which]
    # gaps are whole numbers of 2**-40: their sums are exact, so a point's time depends
    # on its element alone and not on the rows that share the step
    t, end, unit = np.zeros(len(which), np.int64), limit[doc], positions * length * 2.0**40
    flat = sig.reshape(-1)
    drawn = 0
    while len(seed):
        k = max(1, 8192 // len(seed))
        s = seed[:, None] + np.arange(drawn + 1, drawn + k + 1, dtype=np.uint64) * _STEP
        u = (mix64(s) >> np.uint64(11)).astype(np.float64)
        ticks = t[:, None] + np.cumsum(np.rint(-np.log((u + 1) * 2.0**-53) * 2.0**40).astype(np.int64), axis=1)
        times = ticks / unit[:, None]
        i, j = np.nonzero(times < end[:, None])
        v = mix64(s[i, j] ^ _MUL[41])
        place = ((v >> np.uint64(32)) * np.uint64(positions)) >> np.uint64(32)
        inside = low[i] + (v & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * length[i] < top[i]
        np.minimum.at(flat, (doc[i] * positions + place.astype(np.int64))[inside], times[i, j][inside])
        drawn += k
        on = times[:, -1] < end
        seed, t, end, unit, length, low, top, doc = seed[on], ticks[on, -1], end[on], unit[on], length[on], low[on], top[on], doc[on]


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band of each signature (n_rows x bands)."""
    bits = sig.view(np.uint64).reshape(len(sig), bands, -1)
    key = np.zeros(bits.shape[:2], np.uint64)
    for k in range(bits.shape[2]):
        key = mix64(key ^ bits[:, :, k])
    return mix64(key + np.arange(bands, dtype=np.uint64) * _MUL[42])


_SIGNED = "doc_id {id}, th bigint, node bigint, n_shingles bigint, bands array<bigint>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for i, j in steps(offsets):
            lo = offsets[i]
            row, h, w = shingles(data[lo : offsets[j]], offsets[i : j + 1] - lo)
            n = j - i
            # the multiset's fingerprint: a sum over elements, so no order counts
            node = np.zeros(n, np.uint64)
            np.add.at(node, row, mix64(h ^ (w.astype(np.uint64) * _MUL[43])))
            total = np.bincount(row, weights=w, minlength=n).astype(np.int64)
            keys = band_keys(bag_minhash(row, h, w, n))
            empty = total == 0
            lens = np.where(empty, 0, BANDS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id")[i:j],
                    batch.column("th")[i:j],
                    pa.array(mix64(node + total.astype(np.uint64)).view(np.int64), mask=empty),
                    pa.array(total),
                    pa.ListArray.from_arrays(np.append(0, np.cumsum(lens)).astype(np.int32), pa.array(keys[~empty].reshape(-1).view(np.int64))),
                ],
                names=["doc_id", "th", "node", "n_shingles", "bands"],
            )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(text_or_empty()).alias("th"), "text")


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), node (fingerprint of the shingle multiset,
    null without a word), n_shingles, bands."""
    return _keyed(docs).mapInArrow(arrow_task(_sign), _SIGNED.format(id=docs.schema["doc_id"].dataType.simpleString()))


def _overlaps(data_a: np.ndarray, off_a: np.ndarray, data_b: np.ndarray, off_b: np.ndarray):
    """Of rows of two columns, as shingle multisets: sizes of a and b, overlap, and
    the (row, hash) of what a holds more of than b: each element's surplus copies."""
    n = len(off_a) - 1
    ra, ha, wa = shingles(data_a, off_a)
    rb, hb, wb = shingles(data_b, off_b)
    row, h, w = np.concatenate([ra, rb]), np.concatenate([ha, hb]), np.concatenate([wa, wb])
    order, runs, size = groups(mix64(h ^ (row.astype(np.uint64) * _MUL[44])))
    twice = size == 2
    one, two = order[runs], order[np.minimum(runs + 1, max(len(order) - 1, 0))]
    in_a = np.where(one < len(ra), w[one], 0) + np.where(twice & (two < len(ra)), w[two], 0)
    in_b = np.where(one >= len(ra), w[one], 0) + np.where(twice & (two >= len(ra)), w[two], 0)
    shared = np.bincount(row[one], weights=np.minimum(in_a, in_b), minlength=n)
    more = np.maximum(in_a - in_b, 0)
    nth = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more - in_b, more)
    extra = mix64(np.repeat(h[one], more) + nth.astype(np.uint64) * _MUL[45])
    return np.bincount(ra, weights=wa, minlength=n), np.bincount(rb, weights=wb, minlength=n), shared, np.repeat(row[one], more), extra


def jaccard(data_a: np.ndarray, off_a: np.ndarray, data_b: np.ndarray, off_b: np.ndarray) -> np.ndarray:
    """Exact weighted Jaccard similarity of the shingle multisets of rows of two columns."""
    size_a, size_b, shared, _, _ = _overlaps(data_a, off_a, data_b, off_b)
    both = size_a + size_b - shared
    return np.divide(shared, both, out=np.zeros(len(both)), where=both > 0)


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (da, oa), (db, ob) = utf8(batch.column("text_a")), utf8(batch.column("text_b"))
            for i, j in steps(oa + ob):
                n = j - i
                size, size_b, shared, row, extra = _overlaps(da[oa[i] : oa[j]], oa[i : j + 1] - oa[i], db[ob[i] : ob[j]], ob[i : j + 1] - ob[i])
                both = size + size_b - shared
                order, count = np.argsort(row, kind="stable"), np.bincount(row, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("a")[i:j], batch.column("b")[i:j],
                        pa.array(np.divide(shared, both, out=np.zeros(n), where=both > 0)),
                        pa.array(size.astype(np.int64)), pa.array(shared.astype(np.int64)),
                        pa.ListArray.from_arrays(np.append(0, np.cumsum(count)).astype(np.int32), pa.array(extra[order].view(np.int64))),
                    ],
                    names=["a", "b", "similarity", "size", "shared", "novel"],
                )

    return run


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Candidate pairs (a, b) with their exact similarity, the size of a, the
    overlap, and what a holds that b lacks."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        arrow_task(_verify(threshold)), "a bigint, b bigint, similarity double, size bigint, shared bigint, novel array<bigint>"
    )


def _cross(tested: DataFrame, root: DataFrame, threshold: float) -> DataFrame:
    """All pairs (a, b) of nodes of different classes that share a pivot p and may
    still be linked, given each node's overlap with p.

    At least one of the two is outside the class of p, so no link of p.  Linked
    nodes share threshold / (1 + threshold) * (|a| + |b|) elements or more, of
    which p holds min(shared) at most.  So they share ``least`` elements that p
    lacks, hence one among each one's rarest (all but least - 1); or both
    overlaps with p reach that number, which takes a partner shorter than p."""
    share = threshold / (1 + threshold)
    own = root.select(F.col("node").alias("p"), F.col("root").alias("root_p"))
    m = (
        tested.select(F.col("b").alias("p"), F.col("a").alias("node"), "size", "shared", "novel")
        .join(root, "node", "left").join(own, "p", "left")
        .withColumn("root", F.coalesce("root", "node")).withColumn("out", F.col("root") != F.coalesce("root_p", "p")).drop("root_p")
    )
    mixed = m.groupBy("p").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.min("size").alias("shortest")).where("x <> y").select("p", "shortest")
    m = materialize(m.join(mixed, "p"), "minhash-mixed")
    partner = F.greatest("shortest", F.ceil(threshold * F.col("size") - 1e-6))
    least = F.greatest(F.lit(1), F.ceil(share * (F.col("size") + partner) - 1e-6) - F.col("shared"))
    e = m.withColumn("take", F.size("novel") - least + 1).where("take > 0").select("p", "node", "root", "out", "take", F.explode("novel").alias("e"))
    often = e.groupBy("p", "e").agg(F.count("*").alias("n"), F.min("root").alias("x"), F.max("root").alias("y"), F.max("out").alias("any_out"))
    rarest = Window.partitionBy("p", "node").orderBy("n", "e")
    e = e.join(often, ["p", "e"]).withColumn("rank", F.row_number().over(rarest)).where("rank <= take and x <> y and any_out")
    e = materialize(e.select("p", "e", "node", "root", "out"), "minhash-elements")
    one = e.where("out").join(e.select("p", "e", F.col("node").alias("b"), F.col("root").alias("root_b")), ["p", "e"]).where("node <> b and root <> root_b")
    room = F.floor(F.col("shared") / share + 1e-6) - F.col("size")
    shortest = F.ceil(threshold * F.col("size") - 1e-6)
    sized = m.withColumn("room", room).where(F.col("room") >= shortest).select("p", "node", "root", "out", "size", "room")
    short = sized.where("out").select("p", F.col("node").alias("a"), F.col("root").alias("root_a"), F.col("size").alias("own"), F.explode(F.sequence(shortest, F.col("room"))).alias("size"))
    two = short.join(sized, ["p", "size"]).where("own <= room and a <> node and root <> root_a")
    either = one.select("node", "b").union(two.select("a", F.col("node").alias("b")))
    return either.select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct()


def classes(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row for each document: doc_id, th, class_id (smallest doc_id of its
    class), n_shingles, class_size, is_first (the row's doc_id is the class id)."""
    signed = materialize(signatures(docs), "minhash-signed")
    nodes = materialize(
        signed.where("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("at"), F.first("bands").alias("bands")),
        "minhash-nodes",
    )
    posted = nodes.select("node", F.explode("bands").alias("key"))
    sizes = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    posted = materialize(posted.join(sizes, "key"), "minhash-posted")  # only buckets of two nodes or more
    # the pivot of a bucket is its node that meets most others in all its buckets: the centre of a family of copies
    met = posted.groupBy("node").agg(F.sum("n").alias("met"))
    pivots = posted.join(met, "node").groupBy("key").agg(F.max(F.struct("met", F.col("node").alias("pivot"))).getField("pivot").alias("pivot"))
    pairs = materialize(posted.join(pivots, "key").where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(), "minhash-pairs")
    used = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    want = nodes.join(used, "node").select("node", F.col("at.doc_id").alias("_id"), F.col("at.th").alias("_th"))
    keyed = _keyed(docs)
    texts = materialize(
        keyed.join(want, keyed.doc_id.eqNullSafe(want._id) & (keyed.th == want._th)).select("node", "text").dropDuplicates(["node"]), "minhash-texts"
    )
    tested = materialize(_verified(pairs, texts, threshold), "minhash-tested")
    links = tested.where(F.col("similarity") >= threshold).select("a", "b")
    root = components(links)
    cross = _cross(tested, root, threshold)
    more = materialize(_verified(cross, texts, threshold).where(F.col("similarity") >= threshold).select("a", "b"), "minhash-more")
    root = components(links.union(more))
    member = signed.join(root, "node", "left").select(
        "doc_id", "th", "n_shingles", F.when(F.col("node").isNull(), F.xxhash64("doc_id", F.lit("empty"))).otherwise(F.coalesce("root", "node")).alias("root")
    )
    heads = member.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return member.join(heads, "root").select("doc_id", "th", "class_id", "class_size", "n_shingles", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("is_first"))


def keep_one(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The documents with one of each class, the one with the smallest doc_id;
    rows repeated in full count as one."""
    first = classes(docs, threshold).where("is_first").select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct()
    keyed = packed(docs).withColumn("text", F.xxhash64(text_or_empty()))
    kept = keyed.join(first, keyed.doc_id.eqNullSafe(first._id) & (keyed.text == first._th), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"]).select("_row.*")



#: The rows of ``classes`` over documents (less ``th``): every pair that shares a shingle is compared.
ORACLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
places AS (SELECT rid, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, least(len(w), 1)) + 1)) AS p FROM d),
bags AS (SELECT rid, w[p : p + {SHINGLE - 1}] AS s, count(*) AS c FROM places GROUP BY ALL),
sizes AS (SELECT rid, sum(c)::BIGINT AS n FROM bags GROUP BY rid),
contents AS (SELECT rid, min(rid) OVER (PARTITION BY w) AS one FROM d),
own AS (SELECT bags.* FROM bags JOIN contents USING (rid) WHERE rid = one),
shared AS (SELECT x.rid AS a, y.rid AS b, sum(least(x.c, y.c)) AS overlap FROM own x JOIN own y ON x.s = y.s AND x.rid < y.rid GROUP BY ALL),
near AS (
  SELECT a, b FROM shared JOIN sizes m ON m.rid = a JOIN sizes n ON n.rid = b WHERE overlap / (m.n + n.n - overlap) >= {SIMILARITY}::DOUBLE
  UNION ALL SELECT one, rid FROM contents SEMI JOIN sizes USING (rid) WHERE one <> rid
),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reached AS (SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
roots AS (SELECT a AS rid, min(b) AS root FROM reached GROUP BY a),
heads AS (SELECT root, min(doc_id) AS class_id, count(*) AS class_size FROM roots JOIN d USING (rid) GROUP BY root)
SELECT doc_id, class_id, class_size::BIGINT AS class_size, coalesce(n, 0)::BIGINT AS n_shingles, doc_id IS NOT DISTINCT FROM class_id AS is_first
FROM d JOIN roots USING (rid) JOIN heads USING (root) LEFT JOIN sizes USING (rid)
"""


__all__ = ["bag_minhash", "band_keys", "classes", "jaccard", "keep_one", "shingles", "signatures"]
