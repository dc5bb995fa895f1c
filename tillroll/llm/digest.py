"""Document fingerprints: quartile bucket digests of hashed byte triplets.

A text's UTF-8 byte triplets are hashed into 256 buckets and counted.  The
digest has the length on a logarithmic scale (2 hex digits), the ratios of the
first and second quartile of the counts to the third (1 digit each), and every
bucket's quartile (2 bits each, 128 digits).  Equal texts have equal digests;
no text is cut.

The difference of two digests adds the bucket steps (0, 1, 2, and 6 for
opposite quartiles), the length steps and the ratio steps, each bounded; the
likeness is 1 minus the difference over its greatest value.

``with_next`` compares each document with an edit of it and with the document
that follows it by id.  The ids are cut into ranges at quantiles that are ids
themselves; the first document of a range is also sent to the end of the range
before it (that of the first range to the last), so each range is sorted and
read once, in one shuffle of the texts, and none needs another.

Defined cases: null is empty; texts of less than three bytes have no triplet
and differ by length only; two empty texts have likeness 1.
Rows are ordered by id, null last, then by text; a single document follows itself;
a very long text is digested whole; an empty table gives an empty result; columns
other than doc_id and text are not read.  Ids are numbers: the ranges are cut at
their quantiles, so text ids fail.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import arrow_task, steps, text_or_empty, utf8

#: Bytes of text counted in one vectorised step.
STEP = 1 << 18

BUCKETS = 256
_BODY = BUCKETS // 4
_BIG = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_LENGTH_MOST, _LENGTH_STEP, _RATIO_STEP = 24, 2, 2
#: Greatest difference: all buckets opposite, lengths and ratios as far apart as counts.
MOST = 6 * BUCKETS + _LENGTH_MOST * _LENGTH_STEP + 2 * 15 * _RATIO_STEP


def bucket_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Triplet counts of each text (n x 256)."""
    n, length = len(offsets) - 1, np.diff(offsets)
    if len(data) < 3:
        return np.zeros((n, BUCKETS), np.int64)
    doc = np.repeat(np.arange(n, dtype=np.int32) * BUCKETS, length)
    whole = doc[:-2] == doc[2:]  # the triplet ends in the text it starts in
    wide = data.astype(np.uint32) + np.uint32(1)
    h = wide[:-2] * _BIG[0] ^ wide[1:-1] * _BIG[1] ^ wide[2:] * _BIG[2]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    key = (h >> np.uint32(24)).astype(np.int32) + doc[:-2]
    return np.bincount(key[whole], minlength=n * BUCKETS).reshape(n, BUCKETS)


def digests(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The digests of texts as bytes (n x 67): length code, two ratios, 64 packed bucket bytes."""
    counts = bucket_counts(data, offsets)
    ordered = np.sort(counts, axis=1)
    q1, q2, q3 = (ordered[:, BUCKETS * k // 4 - 1] for k in (1, 2, 3))
    quartile = ((counts > q1[:, None]).astype(np.uint8) + (counts > q2[:, None]) + (counts > q3[:, None])).reshape(len(counts), _BODY, 4)
    out = np.empty((len(counts), 3 + _BODY), np.uint8)
    out[:, 0] = np.minimum(255, np.round(np.log1p(np.diff(offsets)) / np.log(1.1)))
    top = np.maximum(q3, 1)
    out[:, 1], out[:, 2] = q1 * 15 // top, q2 * 15 // top
    out[:, 3:] = quartile[:, :, 0] << 6 | quartile[:, :, 1] << 4 | quartile[:, :, 2] << 2 | quartile[:, :, 3]
    return out


def to_hex(digest: np.ndarray) -> list[str]:
    """Text form: 2 digits of length, 1 of each ratio, 128 of buckets."""
    head = digest[:, :1]
    ratio = digest[:, 1:2] << 4 | digest[:, 2:3]
    return [bytes(row).hex() for row in np.concatenate([head, ratio, digest[:, 3:]], axis=1)]


_pair = np.arange(256)
_step = np.abs(((_pair[:, None, None] >> np.array([6, 4, 2, 0])) & 3) - ((_pair[None, :, None] >> np.array([6, 4, 2, 0])) & 3))
#: Difference of two packed bytes of four buckets.
_BYTE_STEP = np.where(_step == 3, 6, _step).sum(axis=2).astype(np.int32).reshape(-1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness (0 to 1) of digests, row by row."""
    body = _BYTE_STEP[a[:, 3:].astype(np.int32) * 256 + b[:, 3:]].sum(axis=1)
    gap = np.abs(a[:, :3].astype(np.int32) - b[:, :3])
    head = np.minimum(gap[:, 0], _LENGTH_MOST) * _LENGTH_STEP + (gap[:, 1] + gap[:, 2]) * _RATIO_STEP
    return 1.0 - (body + head) / MOST


def digest_all(texts: list[str]) -> np.ndarray:
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    parts = [digests(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in steps(offsets, STEP)]
    return np.concatenate(parts) if parts else np.zeros((0, 3 + _BODY), np.uint8)


def _spread(bounds: list[int], end: int):
    """Give each document its range, and the first of each range also to the range before."""
    edges = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            none = np.asarray(ids.is_null())
            key = np.asarray(ids.cast(pa.int64()).fill_null(0))
            part = np.where(none, end, np.maximum(np.searchsorted(edges, key, "right") - 1, 0))
            table = pa.Table.from_batches([batch])
            yield from table.append_column("part", pa.array(part.astype(np.int32))).append_column("after", pa.array(np.zeros(len(part), bool))).to_batches()
            first = np.flatnonzero(~none & (edges[np.minimum(part, len(edges) - 1)] == key)) if len(edges) else np.arange(len(part))
            if len(first):
                before = np.where(part[first] == 0, end, part[first] - 1).astype(np.int32)
                again = table.take(pa.array(first))
                yield from again.append_column("part", pa.array(before)).append_column("after", pa.array(np.ones(len(first), bool))).to_batches()

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list = []  # the last row so far: its next document comes with the next batch
    for batch in batches:
        rows = held + list(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "part", "after"))))
        held = rows[-1:]
        if len(rows) < 2:
            continue
        digest = digest_all([r[1] for r in rows])
        at = [i for i in range(len(rows) - 1) if not rows[i][3]]  # each is followed by a row of its range
        edited = []
        for i in at:
            text, following = rows[i][1], rows[i + 1][1]
            half = len(text) // 2
            edited.append(text[: len(text) - half] + following[:half])
        after = digest_all(edited)
        own, following = digest[at], digest[[i + 1 for i in at]]
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array([rows[i][0] for i in at], batch.schema.field("doc_id").type),
            "n_chars": pa.array([len(rows[i][1]) for i in at], pa.int64()),
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
            "fingerprint": to_hex(own),
            "edited_fingerprint": to_hex(after),
            "near_edited": likeness(own, after),
            "near_next": likeness(own, following),
        })


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next: each document against its edit (the last half of its
    characters replaced by the first as many of the next document) and the next."""
    spark = docs.sparkSession
    ranges = ranges or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", text_or_empty().alias("text"))
    found = docs.agg(F.percentile_approx("doc_id", [k / ranges for k in range(ranges)], 100 * ranges), F.min("doc_id")).first()
    bounds = sorted({*(found[0] or []), *([found[1]] if found[1] is not None else [])})
    kind = docs.schema["doc_id"].dataType.simpleString()
    spread = docs.mapInArrow(arrow_task(_spread(bounds, max(len(bounds) - 1, 0))), f"doc_id {kind}, text string, part int, after boolean")
    ordered = spread.repartition(ranges, "part").sortWithinPartitions("part", "after", F.col("doc_id").asc_nulls_last(), "text")
    return ordered.mapInArrow(arrow_task(_compare), f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
