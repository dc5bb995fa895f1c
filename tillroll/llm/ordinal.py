"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight for each hashed feature is shared by all grades; ordered thresholds
cut the score: P(grade <= j) = sigmoid(threshold_j - w.x).  Selection uses the
expected grade and the tail probability P(grade >= j).

Features are the presence of words (runs of letters, A-Z as a-z) and of marks
(runs of one kind of other character), hashed; each is divided by the square
root of the text's number of features up to a length, beyond which a text's
feature counts in full, so a few telling words weigh the same in a long text.
Whole texts are read.  The fit takes the labelled rows with the smallest id
hashes, at most ``most`` of them (a documented bound of the training sample);
their features come to the driver.  Scoring covers all documents.

Defined cases: null and empty texts have no feature and score by the thresholds
alone; rows without a label or with a null grade are not learned from; several
labels of a document are one row each; with fewer than two grades there is no
threshold and every text gets the one grade (0 if none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import BYTE_CODE_LOWER, arrow_task, extended, prefix_hash, span_hash, steps, utf8, without

BITS = 18
#: Labelled rows that a fit may take.
MOST = 20_000

_kind = np.zeros(256, np.uint8)  # 0 space, 1 letter, 2 digit, then each mark for itself
_kind[33:127] = np.arange(33, 127)
_kind[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_kind[48:58] = 2


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Row and hashed feature, each pair once, rows in order."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _kind[data]
    new = np.ones(len(data), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[offsets[offsets < len(data)]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(data))
    run = kind[starts] > 0
    starts, ends = starts[run], ends[run]
    # a run of a mark counts as one or as several
    ends = np.where(kind[starts] > 2, np.minimum(ends, starts + 2), ends)
    bucket = span_hash(prefix_hash(data, BYTE_CODE_LOWER), starts, ends) >> np.uint64(64 - bits)
    row = np.searchsorted(offsets, starts, "right") - 1
    key = np.unique(row.astype(np.int64) << bits | bucket.astype(np.int64))
    return key >> bits, key & ((1 << bits) - 1)


def _scaled(row: np.ndarray, n: int) -> np.ndarray:
    count = np.bincount(row, minlength=n)
    return 1.0 / np.sqrt(np.clip(count, 1, 64))


def _extract(bits: int):
    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in steps(offsets):
                row, f = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], bits)
                ends = np.append(0, np.cumsum(np.bincount(row, minlength=j - i))).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, pa.array(f.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("place")[i:j], batch.column("grade")[i:j].cast(pa.int32()), lists], names=["place", "grade", "f"])

    return run


class Model:
    def __init__(self, weights: np.ndarray, thresholds: np.ndarray, grades: list[int]):
        self.weights, self.thresholds, self.grades = weights, thresholds, grades

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for every grade but the lowest (n x grades-1)."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds - score[:, None], -50, 50)))


def fit(rated: DataFrame, most: int = MOST, bits: int = BITS, rounds: int = 120, decay: float = 5e-5) -> Model:
    """Fit on rows (doc_id, text, grade); full-batch Adam in numpy on the bounded sample."""
    known = rated.where("grade is not null").select(F.struct(F.xxhash64("doc_id", F.lit(7)).alias("h"), "doc_id", "grade").alias("place"), "text", "grade")
    place = known.schema["place"].dataType.simpleString()
    # features first: no task gathers the texts
    features_ = known.mapInArrow(_extract(bits), f"place {place}, grade int, f array<int>")
    got = features_.orderBy("place").limit(most).select("grade", "f").toArrow().combine_chunks()
    grade = got.column("grade").to_numpy()
    grades = sorted(set(grade.tolist()))
    n, cuts = len(grade), max(len(grades) - 1, 0)
    if not cuts:
        return Model(np.zeros(1 << bits), np.zeros(0), grades or [0])
    y = np.searchsorted(grades, grade)
    lists = got.column("f").combine_chunks()
    row = np.repeat(np.arange(n, dtype=np.int32), np.asarray(lists.value_lengths()))
    f = np.asarray(lists.flatten())
    scale = _scaled(row, n)[row].astype(np.float32)
    del got, lists
    share = np.bincount(y, minlength=cuts + 1) / n
    weight = (share**-0.5)[y]  # between equal rows and equal grades
    weight /= weight.sum()
    # thresholds as the first and the logs of the gaps, so they stay ordered
    p = [np.zeros(1 << bits), np.append(-1.0, np.zeros(cuts - 1))]
    m, v = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    for t in range(1, rounds + 1):
        w, gaps = p
        theta = np.cumsum(np.append(gaps[0], np.exp(gaps[1:])))
        s = np.bincount(row, weights=w[f] * scale, minlength=n)
        upper, lower = np.append(theta, np.inf)[y], np.append(-np.inf, theta)[y]
        hi, lo = 1 / (1 + np.exp(np.clip(s - upper, -50, 50))), 1 / (1 + np.exp(np.clip(s - lower, -50, 50)))
        lo[y == 0], hi[y == cuts] = 0.0, 1.0
        # of -log(hi - lo): by the score 1 - hi - lo, by the thresholds the logistic densities over the difference
        ds = weight * (1 - hi - lo)
        gap = np.maximum(hi - lo, 1e-12)
        up, down = -weight * hi * (1 - hi) / gap, weight * lo * (1 - lo) / gap
        dt = np.bincount(np.minimum(y, cuts - 1), weights=np.where(y < cuts, up, 0), minlength=cuts) + np.bincount(np.maximum(y - 1, 0), weights=np.where(y > 0, down, 0), minlength=cuts)
        behind = np.cumsum(dt[::-1])[::-1]
        grads = [np.bincount(f, weights=ds[row] * scale, minlength=1 << bits) + decay * w, np.append(behind[0], behind[1:] * np.exp(gaps[1:]))]
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p[k] = p[k] - 0.1 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-6)
    return Model(p[0], np.cumsum(np.append(p[1][0], np.exp(p[1][1:]))), grades)


def _score(shared, bits: int):
    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        grades = np.asarray(model.grades, float)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            expected, tail = [np.zeros(0)], [np.zeros(0)]
            for i, j in steps(offsets):
                row, f = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], bits)
                s = np.bincount(row, weights=model.weights[f], minlength=j - i) * _scaled(row, j - i)
                tails = model.tails(s)
                expected.append(grades[0] + (tails * np.diff(grades)).sum(axis=1))
                tail.append(tails[:, -1] if tails.shape[1] else np.ones(j - i))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(expected)), pa.array(np.concatenate(tail))], names=[*batch.schema.names, "expected_grade", "p_top"]
            )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs with expected_grade and p_top, the probability of the
    highest grade; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bits = int(len(model.weights)).bit_length() - 1
    docs = without(docs, "expected_grade", "p_top")
    return docs.mapInArrow(_score(shared, bits), extended(docs, "expected_grade double, p_top double"))
