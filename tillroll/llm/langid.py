"""Language identification by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; n-grams of one to three characters around letters (every
other character is one boundary mark) are hashed into buckets.  Training counts
(language, bucket) over all training documents, pre-aggregated by task and
summed in Spark; the smoothed log-probability matrix (buckets x languages, its
size fixed by parameters and the number of languages) goes to the workers,
where numpy adds it over the n-grams of each text.

Defined cases: a null text or one without a letter is ``und`` with score 0, and
so is every text if nothing was learned; ties go to the smallest language name;
rows with a null language are not learned from; null ids count as empty text in
``held_out``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import arrow_task, extended, id_remainder, steps, utf8, without

BITS = 14
SMOOTHING = 0.5
UNKNOWN = "und"
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_letters: list[np.ndarray] = []
_STEP = 1 << 18


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngrams(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and bucket of every n-gram, and the number of letters of each text."""
    low = [t.lower() for t in texts]
    code = np.frombuffer("\0".join(["", *low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, low), np.int64, len(low)) + 1
    doc = np.repeat(np.arange(len(low), dtype=np.int32), size)  # of code[1:]
    letter = _is_letter()[code]
    c = np.where(letter, code, 0).astype(np.uint64)
    shift = np.uint64(64 - bits)
    mid, left, right = c[1:-1], c[:-2], c[2:]
    on = letter[1:-1]
    doc = doc[: len(mid)]
    hashed = ((mid + np.uint64(1)) * _A, (left * _B + mid + np.uint64(7)) * _A, ((left * _B + mid) * _C + right + np.uint64(13)) * _A)
    which, bucket = [], []
    for h in hashed:
        h = h[on]
        h ^= h >> np.uint64(29)
        bucket.append(((h * _C) >> shift).astype(np.int32))
        which.append(doc[on])
    return np.concatenate(which), np.concatenate(bucket), np.bincount(doc[on], minlength=len(low))


def _count(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            langs, text = batch.column("lang").to_pylist(), batch.column("text")
            _, offsets = utf8(text)
            for i, j in steps(offsets, _STEP):
                doc, bucket, _ = ngrams([t or "" for t in text[i:j].to_pylist()], bits)
                own = sorted(set(langs[i:j]))
                number = np.array([own.index(x) for x in langs[i:j]])
                counts = np.bincount(number[doc] * (1 << bits) + bucket, minlength=len(own) << bits).reshape(len(own), -1)
                for k, lang in enumerate(own):
                    total[lang] = total.get(lang, 0) + counts[k]
                    rows[lang] = rows.get(lang, 0) + int((number == k).sum())
        for lang, counts in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * (len(used) + 1), pa.string()),
                "bucket": pa.array(np.append(used, -1).astype(np.int32)),
                "n": pa.array(np.append(counts[used], rows[lang])),
            })

    return run


def train(docs: DataFrame, bits: int = BITS, smoothing: float = SMOOTHING) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages (sorted), log-probabilities (buckets x languages) and log-priors,
    from all rows of (text, lang) with a language.  What comes to the driver is
    one number for each bucket and language."""
    counted = docs.where("lang is not null").select("text", "lang").mapInArrow(arrow_task(_count(bits)), "lang string, bucket int, n bigint")
    got = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique().tolist())
    counts, rows = np.zeros((1 << bits, len(langs))), np.zeros(len(langs))
    column = got["lang"].map({x: k for k, x in enumerate(langs)}).to_numpy(dtype=np.int64)
    bucket, n = got["bucket"].to_numpy(), got["n"].to_numpy()
    is_row = bucket < 0
    rows[column[is_row]] = n[is_row]
    counts[bucket[~is_row], column[~is_row]] = n[~is_row]
    log_p = np.log(counts + smoothing) - np.log(counts.sum(axis=0) + smoothing * len(counts))
    return langs, log_p, np.log(rows / max(rows.sum(), 1))


def _predict(langs: list[str], matrix, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_p, prior = matrix.value
        names = np.array([*langs, UNKNOWN], object)
        for batch in batches:
            text = batch.column("text")
            _, offsets = utf8(text)
            pred, score = [], []
            for i, j in steps(offsets, _STEP):
                doc, bucket, letters = ngrams([t or "" for t in text[i:j].to_pylist()], bits)
                if not langs:
                    pred.append(np.zeros(j - i, np.int64))
                    score.append(np.zeros(j - i))
                    continue
                total = np.stack([np.bincount(doc, weights=log_p[bucket, k], minlength=j - i) for k in range(len(langs))], axis=1) + prior
                best = total.argmax(axis=1)
                odds = np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                pred.append(np.where(letters > 0, best, len(langs)))
                score.append(np.where(letters > 0, 1 / odds, 0.0))
            at = np.concatenate(pred) if pred else np.zeros(0, np.int64)
            arrays = [*batch.columns, pa.array(names[at].tolist(), pa.string()), pa.array(np.concatenate(score) if score else np.zeros(0))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """All columns of docs with lang_pred and score, the posterior probability;
    columns of these names are replaced."""
    langs, log_p, prior = model
    bits = int(len(log_p)).bit_length() - 1
    matrix = docs.sparkSession.sparkContext.broadcast((log_p, prior))
    docs = without(docs, "lang_pred", "score")
    return docs.mapInArrow(arrow_task(_predict(langs, matrix, bits)), extended(docs, "lang_pred string, score double"))


def held_out(divisor: int = 4, remainder: int = 2):
    return id_remainder("doc_id", divisor) == remainder
