"""Hard negatives by an inverted multi-index with certified windows.

Vectors are whole numbers (``quantised``), so scores are exact inner products.
Each vector is cut into two halves; a codebook of each half space (k-means on a
bounded sample) makes the cells (i, j) of the index.  For an anchor q, no row of
a cell scores more than its two half bounds together,
``q1 . c1_i + |q1| R1_i`` and ``q2 . c2_j + |q2| R2_j``, with R the largest
distance of any row from its codeword.  A heap over the two sorted lists of half
bounds visits the cells in the order of these sums (multi-sequence), so at any
moment no cell still to come holds a higher score than the next sum.

1. Positives: the first ``PROBE`` occupied cells are read; then the visit goes on
   while the next sum may reach the last positive found.
2. Negatives: the cells read so far give each window (between ``low`` and
   ``high`` percent of its positive's score) its first negatives; then the visit
   goes on while the next sum may reach a window's foot, or its last negative
   once it has enough.  A window is certified when the next sum is below that,
   so the result is that of reading every row.

Every row is indexed.  Rows of a cell lie in chunks of about ``CHUNK`` rows,
dealt by a hash of the id, so a cell of equal vectors is spread; a chunk returns
each anchor's best few, and the best of all chunks are the answer.  Anchors that
visit a chunk come in blocks of about ``BLOCK``.  The directory that is broadcast
holds at most ``CODES`` squared cells.

Defined cases: rows with a null id, label or vector, or with a null or
non-finite component take no part; nor do rows whose vector has another length
than most (ties: the shorter); rows of the anchor's own id are neither its
positives nor its negatives; repeated rows count as rows of their own, but the
smallest (label, vector) of an id is its one anchor; ties go to
the smaller id; a window of a positive below zero is empty; an empty table gives
no row; other columns are not read.  A component of 2**40 or more is an error,
as scores must fit a long.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import arrow_task, materialize

#: Rows that codebooks are fitted on, at most; codewords of a half, at most; rows of a cell aimed at.
SAMPLE, CODES, CELL = 8192, 64, 2048
#: Rows of a chunk and anchors of a block, about.
CHUNK, BLOCK = 8192, 1024
#: Tasks that walk the cells for the anchors of a block.
SPREAD = 8
#: Cells read before the first bound.
PROBE = 4


def quantised(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, in double precision, as long."""
    return F.transform(embedding.cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))


def valid(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, v) of the rows (vec_id, label, embedding) that take part."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    small = F.forall(x, lambda c: F.abs(c) * F.lit(float(scale)) < float(1 << 40))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & (F.size(x) > 0) & finite)
    v = F.when(small, quantised(F.col("embedding"), scale)).otherwise(F.raise_error(F.lit("a component is too large for exact scores")).cast("array<bigint>"))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))


# ------------------------------------------------------------------- index


def codebook(x: np.ndarray, codes: int, rounds: int = 12) -> np.ndarray:
    """k-means of the sampled halves; codewords that lose all rows stay where they are."""
    rng = np.random.default_rng(0)
    points = np.unique(x, axis=0)
    c = points[rng.permutation(len(points))[:codes]].astype(float)
    for _ in range(rounds):
        own = _nearest(x, c)
        n = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[n > 0] = total[n > 0] / n[n > 0][:, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c**2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1) if len(x) else np.zeros(0, np.int64)


class Directory:
    """The codebooks, each codeword's radius, and the number of chunks of each occupied cell."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], radii: tuple[np.ndarray, np.ndarray], chunks: dict[tuple[int, int], int]):
        self.books, self.radii, self.chunks = books, radii, chunks

    def visit(self, q: np.ndarray) -> Iterator[tuple[float, tuple[int, int]]]:
        """Occupied cells with their bounds, the highest first: multi-sequence over the
        two sorted lists of half bounds."""
        half = len(self.books[0][0])
        parts = (q[:half].astype(float), q[half:].astype(float))
        bounds = [c @ p + np.sqrt((p**2).sum()) * r for c, p, r in zip(self.books, parts, self.radii)]
        # a little more, for rounding in these sums
        bounds = [b + 1e-9 * (np.abs(b) + np.abs(p).sum() * np.abs(c).max(initial=0)) + 1e-6 for b, p, c in zip(bounds, parts, self.books)]
        first, second = (np.argsort(-b, kind="stable") for b in bounds)
        one, two = bounds[0][first], bounds[1][second]
        heap, seen = [(-(one[0] + two[0]), 0, 0)], {(0, 0)}
        while heap:
            top, a, b = heapq.heappop(heap)
            cell = (int(first[a]), int(second[b]))
            if cell in self.chunks:
                yield -top, cell
            for at in ((a + 1, b), (a, b + 1)):
                if at[0] < len(one) and at[1] < len(two) and at not in seen:
                    seen.add(at)
                    heapq.heappush(heap, (-(one[at[0]] + two[at[1]]), *at))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(values), -1)


def _assign(books):
    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v")).astype(float)
            half = len(books[0][0])
            out = []
            for c, part in zip(books, (x[:, :half], x[:, half:])):
                own = _nearest(part, c)
                out += [pa.array(own.astype(np.int32)), pa.array(np.sqrt(((part - c[own]) ** 2).sum(axis=1)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*batch.schema.names, "i", "ri", "j", "rj"])

    return run


def _pack(table: pa.Table) -> pa.Table:
    return pa.table({
        "i": table.column("i")[:1], "j": table.column("j")[:1], "sub": table.column("sub")[:1],
        "ids": [table.column("vec_id").to_numpy().tobytes()], "labels": [table.column("label").to_numpy().tobytes()], "vectors": [_matrix(table.column("v")).tobytes()],
    })


def build(rows: DataFrame, codes: int | None = None) -> tuple[DataFrame, Directory] | None:
    """The index of rows (vec_id, label, v): packed chunks of cells, and the directory; None without rows."""
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    if lengths is None:
        return None
    own, n = rows.where(F.size("v") == lengths["d"]), lengths["count"]
    codes = codes or int(min(CODES, max(2, round((n / CELL) ** 0.5))))
    sample = own.select("v", F.xxhash64("vec_id", F.lit(13)).alias("h"), "vec_id").orderBy("h", "vec_id", "v").limit(SAMPLE).select("v").toArrow()
    x = _matrix(sample.column("v")).astype(float)
    half = x.shape[1] // 2
    books = (codebook(x[:, :half], codes), codebook(x[:, half:], codes))
    placed = materialize(own.mapInArrow(_assign(books), "vec_id bigint, label bigint, v array<bigint>, i int, ri double, j int, rj double"), "negatives-cells")
    cells = placed.groupBy("i", "j").agg(F.count("*").alias("n"), F.max("ri").alias("ri"), F.max("rj").alias("rj")).collect()  # at most codes squared
    radii = tuple(np.zeros(len(c)) for c in books)
    for r in cells:
        radii[0][r["i"]] = max(radii[0][r["i"]], r["ri"])
        radii[1][r["j"]] = max(radii[1][r["j"]], r["rj"])
    chunks = {(r["i"], r["j"]): -(-r["n"] // CHUNK) for r in cells}
    made = own.sparkSession.createDataFrame([(i, j, c) for (i, j), c in chunks.items()], "i int, j int, chunks int")
    # as many rows as cells, bounded by CODES
    dealt = placed.join(F.broadcast(made), ["i", "j"]).withColumn("sub", F.pmod(F.xxhash64("vec_id", F.lit(17)), F.col("chunks")).cast("int"))
    packed = dealt.select("i", "j", "sub", "vec_id", "label", "v").groupBy("i", "j", "sub").applyInArrow(_pack, "i int, j int, sub int, ids binary, labels binary, vectors binary")
    return materialize(packed, "negatives-index"), Directory(books, radii, chunks)


# ------------------------------------------------------------------ search


def scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products (anchors x rows)."""
    most = int(np.abs(x).max(initial=0)) * int(np.abs(q).max(initial=0)) * x.shape[1]
    if most < 1 << 53:  # exact in double precision
        return np.rint(q.astype(float) @ x.astype(float).T).astype(np.int64)
    if most >= 1 << 63:
        raise ValueError("scores do not fit a long")
    return q @ x.T


def _visits(shared, probe: int):
    """Cells that an anchor reads now: the first ones (``floor`` null), or all that
    it has not read and whose bound reaches ``floor``."""

    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory = shared.value
        for batch in batches:
            q, again = _matrix(batch.column("v")) if batch.num_rows else (), batch.column("read").to_pylist()
            floors = batch.column("floor").to_pylist()
            who, cells, subs, read = [], [], [], []
            for k in range(batch.num_rows):
                last = again[k]
                for n, (bound, cell) in enumerate(directory.visit(q[k])):
                    if floors[k] is None:
                        if n >= probe and last is None:
                            break
                    elif bound < floors[k]:
                        break
                    if last is not None and n < last:
                        continue
                    for sub in range(directory.chunks[cell]):
                        who.append(k)
                        cells.append(cell)
                        subs.append(sub)
                        read.append(n + 1)
            ids = batch.column("anchor_id").take(pa.array(np.array(who, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()), pa.array(subs, pa.int32()), pa.array(read, pa.int32())],
                names=["anchor_id", "i", "j", "sub", "read"],
            )

    return run


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    if len(score) > 4 * k:
        on = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return on[np.lexsort((ids[on], -score[on]))[:k]]
    return np.lexsort((ids, -score))[:k]


def _scan(k: int, windows: bool, low: int, high: int):
    """Best ``k`` rows of a chunk for each anchor, or for each of its windows."""

    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
                x, asked = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), -1), row["asked"]
                s = scores(x, np.array([a["v"] for a in asked], np.int64))
                out: list[tuple] = []
                for a, own in zip(asked, s):
                    other = ids != a["anchor_id"]
                    same = labels == a["label"]
                    if not windows:
                        on = np.flatnonzero(other & same)
                        out += [(a["anchor_id"], None, int(ids[t]), None, int(own[t])) for t in on[_best(own[on], ids[on], k)]]
                        continue
                    on = np.flatnonzero(other & ~same)
                    for p in a["positives"]:
                        at = p["positive_score"]
                        foot, head = -(-low * at // 100), high * at // 100
                        inside = on[(own[on] >= foot) & (own[on] <= head)]
                        out += [(a["anchor_id"], p["positive_id"], int(ids[t]), at, int(own[t])) for t in inside[_best(own[inside], ids[inside], k)]]
                names = ["anchor_id", "positive_id", "vec_id", "positive_score", "score"]
                columns = list(zip(*out)) if out else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, codes: int | None = None, probe: int = PROBE) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and
    negative_score; rows and anchors are ``valid`` rows (vec_id, label, v)."""
    spark = rows.sparkSession
    rows = materialize(rows, "negatives-rows")
    built = build(rows, codes)
    if built is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    chunks, directory = built
    shared = spark.sparkContext.broadcast(directory)
    size = len(directory.books[0][0]) + len(directory.books[1][0])
    once = anchors.where(F.size("v") == size).groupBy(F.col("vec_id").alias("anchor_id")).agg(F.min(F.struct("label", "v")).alias("row"))
    asked = materialize(once.select("anchor_id", "row.*"), "negatives-anchors")
    blocks = -(-asked.count() // BLOCK) or 1

    def scan(visits: DataFrame, of: DataFrame, k: int, windows: bool) -> DataFrame:
        # visits, and anchors once for each, pack to a small part of their size in files: estimates from that may not broadcast them
        fields = ["anchor_id", "label", "v", *(["positives"] if windows else [])]
        block = F.pmod(F.xxhash64("anchor_id", F.lit(19)), F.lit(blocks)).alias("block")
        visits = visits.select("anchor_id", "i", "j", "sub").hint("merge").join(of.select(*fields), "anchor_id")
        packed = visits.groupBy("i", "j", "sub", block).agg(F.collect_list(F.struct(*fields)).alias("asked")).drop("block")
        joined = chunks.hint("merge").join(packed, ["i", "j", "sub"]).select("ids", "labels", "vectors", "asked")
        return joined.mapInArrow(_scan(k, windows, low, high), "anchor_id bigint, positive_id bigint, vec_id bigint, positive_score bigint, score bigint")

    def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    def visit(of: DataFrame) -> DataFrame:
        of = of.select("anchor_id", "v", "read", "floor").repartition(blocks * SPREAD, "anchor_id")
        return of.mapInArrow(_visits(shared, probe), "anchor_id bigint, i int, j int, sub int, read int")

    # positives: the first cells, then all that may hold a better one
    probed = materialize(visit(asked.select("*", F.lit(None).cast("int").alias("read"), F.lit(None).cast("double").alias("floor"))), "negatives-visits")
    near = materialize(first(scan(probed, asked, positives, False), ["anchor_id"], positives), "negatives-near")
    reach = probed.groupBy("anchor_id").agg(F.max("read").alias("read"))
    floor = near.groupBy("anchor_id").agg(F.count("*").alias("n"), F.min("score").alias("last"))
    enough = F.when(F.col("n") >= positives, F.col("last").cast("double")).otherwise(F.lit(float("-inf")))
    rest = asked.join(reach, "anchor_id").join(floor, "anchor_id", "left").select("anchor_id", "v", "read", enough.alias("floor"))
    later = materialize(visit(rest), "negatives-visits")
    fields = ["anchor_id", "vec_id", "score"]
    best = first(near.select(*fields).union(scan(later, asked, positives, False).select(*fields)), ["anchor_id"], positives)
    own = F.sort_array(F.collect_list(F.struct(F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))))
    # a window below zero holds nothing
    best = materialize(best.where("score >= 0").groupBy("anchor_id").agg(own.alias("positives")), "negatives-positives")

    # negatives: the cells read so far, then all that may reach a window
    known, of = probed.union(later), asked.join(best, "anchor_id")
    pairs = ["anchor_id", "positive_id", "positive_score"]
    hard = materialize(first(scan(known, of, negatives, True), pairs, negatives).select(*pairs, "vec_id", "score"), "negatives-hard")
    full = hard.groupBy(*pairs).agg(F.count("*").alias("n"), F.min("score").alias("last"))
    each = best.select("anchor_id", F.explode("positives").alias("p")).select("anchor_id", "p.*")
    foot = F.ceil(F.lit(low) * F.col("positive_score") / 100).cast("double")
    floors = each.join(full, pairs, "left").withColumn("floor", F.when(F.col("n") >= negatives, F.col("last").cast("double")).otherwise(foot)).groupBy("anchor_id").agg(F.min("floor").alias("floor"))
    reach = known.groupBy("anchor_id").agg(F.max("read").alias("read"))
    rest = of.join(floors, "anchor_id").join(reach, "anchor_id", "left").select("anchor_id", "v", "read", "floor")
    more = materialize(visit(rest), "negatives-visits")
    found = hard.union(scan(more, of, negatives, True).select(*pairs, "vec_id", "score"))
    return first(found, pairs, negatives).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ORACLE_SQL = r"""
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM given a JOIN given b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""
