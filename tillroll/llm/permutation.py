"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of the pivots by their distance from it.
The index is a set of shards of bounded size, dealt by a hash of the id; a
shard holds one inverted file for each pivot: the place of that pivot in the
order of each of the shard's vectors.  A query ranks a shard's vectors by the
footrule distance of the orders, summed file by file, and the best part of them
(``rerank``), with all that tie with its last, is ranked again by the exact
Euclidean distance on the original vectors.  A shard holds equal vectors once,
with their ids in order, so copies crowd out nothing.  A shard returns its best;
the best of all shards are the answer.

Every row is indexed.  The pivots are a bounded sample: the ``PIVOTS`` vectors
with the smallest id hashes.  The query set meets the shards in blocks.

Defined cases: null or zero vectors, vectors holding a null or a value that is
not finite, and null ids take no part; vectors of different lengths are not
compared; a query's own id is no candidate; rows repeated under one id are
candidates of their own; ties go to the smaller id; with fewer candidates than
asked for, all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import arrow_task, materialize

#: Sampled pivots; their places fit a byte.
PIVOTS = 128
#: Vectors of a shard and queries of a block, about.
SHARD, BLOCK = 8192, 1024
#: Part of a shard that is ranked by exact distance, and the least number.
RERANK, RERANK_LEAST = 0.125, 256
#: Tasks that the shards are dealt to: so many for each, and at most.
SPREAD, MOST_TASKS = 4, 4096
_ROWS = 64


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, in double precision."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).select("vec_id", v.alias("v"))


def places(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The inverted files of vectors: the place of each pivot in each one's order (pivots x vectors)."""
    d = ((x[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2) if len(x) * pivots.size < 1 << 22 else (x**2).sum(axis=1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(axis=1)
    order = np.argsort(d, axis=1, kind="stable")
    out = np.empty(order.shape, np.uint8)
    np.put_along_axis(out, order, np.arange(len(pivots), dtype=np.uint8)[None, :].repeat(len(x), axis=0), axis=1)
    return np.ascontiguousarray(out.T)


def _build(pivots: np.ndarray, distinct: bool):
    def run(table: pa.Table) -> pa.Table:
        n = table.num_rows
        x = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        ids = table.column("vec_id").to_numpy().astype(np.int64)
        x, own = np.unique(x + 0.0, axis=0, return_inverse=True) if distinct else (x, np.arange(n))  # + 0.0: no negative zero
        order = np.lexsort((ids, own.reshape(-1)))
        copies, n = np.bincount(own.reshape(-1), minlength=len(x)).astype(np.int64), len(x)
        files = np.concatenate([places(x[i : i + 256], pivots) for i in range(0, n, 256)], axis=1)
        return pa.table({
            "part": pa.array([table.column("part")[0].as_py()], pa.int32()),
            "ids": [ids[order].tobytes()], "copies": [copies.tobytes()], "files": [files.tobytes()], "vectors": [np.ascontiguousarray(x).tobytes()],
        })

    return run


def build(vectors: DataFrame, pivots: np.ndarray, parts: int, distinct: bool = True) -> DataFrame:
    """Shards of vectors (vec_id, v), each packed: inverted files and vectors, with
    the number of ids of each, and the ids; equal vectors once if ``distinct``."""
    dealt = vectors.select(F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"), F.col("vec_id").cast("long").alias("vec_id"), "v")
    return dealt.groupBy("part").applyInArrow(_build(pivots, distinct), "part int, ids binary, copies binary, files binary, vectors binary")


def _nearest(ids: np.ndarray, copies: np.ndarray, files: np.ndarray, x: np.ndarray, qids: np.ndarray, qfiles: np.ndarray, q: np.ndarray, k: int, rerank: float):
    """Best k of a shard for each query: query numbers, ids, distances."""
    n, first, owner = len(copies), np.cumsum(copies) - copies, np.repeat(np.arange(len(copies)), copies)
    c = min(n, max(RERANK_LEAST, int(np.ceil(len(ids) * rerank)), k + 1))
    which, found, distance = [], [], []
    for i in range(0, len(qids), _ROWS):
        total = np.zeros((len(qids[i : i + _ROWS]), n), np.int32)
        for own, posting in zip(qfiles[:, i : i + _ROWS].astype(np.int16), files):
            total += np.abs(own[:, None] - posting.astype(np.int16)[None, :])
        last = np.partition(total, c - 1, axis=1)[:, c - 1]
        for r in range(len(total)):
            qid, near = qids[i + r], np.flatnonzero(total[r] <= last[r])
            # vectors that only the query's own id has are no candidates
            near = near[copies[near] > np.bincount(owner[ids == qid], minlength=n)[near]]
            d = np.sqrt(((x[near] - q[i + r]) ** 2).sum(axis=1))
            on = d <= np.sort(d)[: k][-1:].max(initial=-1.0)
            each = [own[own != qid][:k] for own in (ids[first[j] : first[j] + copies[j]] for j in near[on])]
            at = np.concatenate([np.zeros(0, np.int64), *each])
            far = np.repeat(d[on], [len(own) for own in each])
            top = np.lexsort((at, far))[:k]
            which.append(np.full(len(top), i + r))
            found.append(at[top])
            distance.append(far[top])
    return np.concatenate(which), np.concatenate(found), np.concatenate(distance)


def _search(k: int, rerank: float, pivots: int):
    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, copies, qids = (np.frombuffer(row[f], np.int64) for f in ("ids", "copies", "qids"))
                files, qfiles = (np.frombuffer(row[f], np.uint8).reshape(pivots, -1) for f in ("files", "qfiles"))
                x, q = np.frombuffer(row["vectors"]).reshape(len(copies), -1), np.frombuffer(row["qvectors"]).reshape(len(qids), -1)
                which, found, distance = _nearest(ids, copies, files, x, qids, qfiles, q, k, rerank)
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(qids[which]), "vec_id": pa.array(found), "score": pa.array(distance)})

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, pivots: int = PIVOTS, rerank: float = RERANK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance) of the k nearest
    found for each row of queries; both inputs have (vec_id, embedding)."""
    rows, asked = materialize(valid(vectors), "permutation-vectors"), valid(queries)
    lengths = rows.groupBy(F.size("v").alias("n")).count().collect()  # one row for each vector length
    out = None
    for length, count in sorted((r["n"], r["count"]) for r in lengths):
        own, mine = rows.where(F.size("v") == length), asked.where(F.size("v") == length)
        sample = own.select("v", F.xxhash64("vec_id", F.lit(3)).alias("h")).groupBy("v").agg(F.min("h").alias("h")).orderBy("h").limit(pivots).collect()
        points = np.array([r["v"] for r in sample])
        n_shards = -(-count // SHARD)
        shards = materialize(build(own, points, n_shards), "permutation-index")
        blocks = build(mine, points, -(-mine.count() // BLOCK) or 1, distinct=False)
        blocks = blocks.select(F.col("ids").alias("qids"), F.col("files").alias("qfiles"), F.col("vectors").alias("qvectors"), F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("part"))
        tasks = min(SPREAD * n_shards, MOST_TASKS)
        # every block stands here once for each shard, which estimates from the size of the query set leave out: no broadcast
        pairs = shards.repartition(tasks, "part").hint("merge").join(blocks.repartition(tasks, "part"), "part")
        found = pairs.select("ids", "copies", "files", "vectors", "qids", "qfiles", "qvectors").mapInArrow(
            _search(k, rerank, len(points)), "query_id bigint, vec_id bigint, score double"
        )
        out = found if out is None else out.union(found)
    if out is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
