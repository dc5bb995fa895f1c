"""The operators of this subpackage as named queries over the test tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bloomlm, digest, langid, minhash, mixing, negatives, ordinal, permutation, phrases, pii, sentencepiece, suffix, toxicity
from tillroll.llm.common import configure_python, materialize, table

Query = Callable[[SparkSession, str], DataFrame]


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, and bound their batches."""
    configure_python(spark)
    sc = spark.sparkContext
    if getattr(sc, "_tillroll_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tillroll-"), "tillroll_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tillroll", os.path.relpath(full, package)))
    sc.addPyFile(path)
    sc._tillroll_shipped = True


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents")).drop("th")


def op2_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.words().alias("size"))
    mixed = mixing.mix(materialize(sized, "mix-sizes"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op3_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op4_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


def op5_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return permutation.search(vectors, vectors.where("vec_id % 100 = 0"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def graded_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of the labelled documents: 0 toxic, 1 low quality, 2 good."""
    labels = table(spark, sf_dir, "labels")
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    grades = graded_labels(spark, sf_dir).where(~langid.held_out())
    # the sample is drawn before the texts are joined
    sample = grades.where("grade is not null").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id", "grade").limit(ordinal.MOST)
    # ids and grades of at most MOST documents; the texts stay where they are
    model = ordinal.fit(docs.join(F.broadcast(sample), "doc_id"))
    scored = ordinal.score(docs.withColumn("held_out", langid.held_out()), model).drop("text")
    return scored.withColumn("selected", F.col("p_top") >= 0.5)


def op8_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.with_next(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", langid.held_out().alias("held_out"))
    model = langid.train(docs.where("not held_out"))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op10_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", bloomlm.held_out().alias("held_out"))
    model, rare = bloomlm.train(docs.where("not held_out"))
    return bloomlm.score(docs, model, rare)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_subsequence_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out()).select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs.withColumn("held_out", toxicity.held_out()), model).drop("text")


def op13_multi_index_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.valid(table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding"))
    return negatives.mine(rows, rows.where("vec_id % 100 = 0"))


_OPERATORS: dict[str, Query] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_systematic_mixing": op2_systematic_mixing,
    "op3_contextual_pii": op3_contextual_pii,
    "op4_suffix_repeats": op4_suffix_repeats,
    "op5_permutation_index": op5_permutation_index,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_ordinal_quality": op7_ordinal_quality,
    "op8_quartile_digest": op8_quartile_digest,
    "op9_language_id": op9_language_id,
    "op10_bloom_lm": op10_bloom_lm,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_subsequence_toxicity": op12_subsequence_toxicity,
    "op13_multi_index_negatives": op13_multi_index_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": minhash.ORACLE_SQL,
    "op2_systematic_mixing": mixing.ORACLE_SQL,
    "op4_suffix_repeats": suffix.ORACLE_SQL,
    "op11_phrase_collocations": phrases.ORACLE_SQL,
    "op13_multi_index_negatives": negatives.ORACLE_SQL,
}


def _shipped(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    return run


QUERIES: dict[str, Query] = {name: _shipped(fn) for name, fn in _OPERATORS.items()}
