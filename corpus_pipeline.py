"""A corpus pipeline from the operators of ``tillroll.llm``: documents in, encoded documents out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and read again as the next stage's docs; all but the last return the
columns of documents, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import langid, minhash, mixing, pii, sentencepiece
from tillroll.llm.common import materialize, table
from tillroll.llm.queries import ship

#: Least posterior probability of the predicted language.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is predicted stay; those without a letter or with
    an unsure prediction go (null and empty texts with them).  Rows of a null lang
    are not learned from but judged as any other; repeated rows are judged each."""
    ship(spark)
    model = langid.train(docs.where(~langid.held_out()).select("text", "lang"))
    rows = langid.predict(docs.select("text", F.struct("*").alias("_row")), model)
    return rows.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("_row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, the one with the smallest
    doc_id; rows repeated in full count as one."""
    ship(spark)
    return minhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; n_chars follows the text."""
    ship(spark)
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    ship(spark)
    mixed = mixing.mix(docs.select("doc_id", "source", mixing.words().alias("size"), F.struct("*").alias("_row")))
    return mixed.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("_row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document, with round_trip: whether they decode to its text."""
    ship(spark)
    return sentencepiece.encode(docs).drop("text")


STAGES = [
    ("language id", language_id),
    ("minhash near-dedup", near_dedup),
    ("personal data", personal_data),
    ("source mixing", mix_sources),
    ("sentencepiece encoding", encode),
]

#: No SQL expresses the first stage; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
