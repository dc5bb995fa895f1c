"""Mixing sources to target weights by systematic sampling.

Every document has an expected number of copies, its source's target over its
source's size.  Within a source the documents stand in a random order within
size octaves (bit length of the size, then a hash of the id); their expected
copies are prefix-summed, one random offset is added, and a document is taken
once for each integer boundary its interval crosses.  A document expecting e
copies gets floor(e) or ceil(e), so what a source's words miss its target by is
ruled by its longest documents, which are taken whole or not.

The prefix sum has two levels: sums of (source, octave, hash prefix) buckets,
then running sums inside a bucket.  A source of any size is spread over its
buckets; no task holds a whole source.  Expected copies are whole numbers of
2**-24, so sums are exact and reruns agree.

Defined cases: null text, or a null size, counts 0; documents without a word and
sources of size 0 add nothing to a target (size-0 sources are not taken, other
empty texts follow their source's rate); a very long text is one document of
its size; a null source is a source of its
own, ordered last; ties in size and repeated rows are documents of their own,
each with its own interval; null ids hash as empty text; an empty table gives
an empty result; further columns are kept whatever their names, but for
source_size, target and copies, which are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import WORD, materialize, text_or_empty, without

#: One copy, in units of the exact prefix sums.
UNIT = 1 << 24


def words(col: str = "text") -> Column:
    """Number of words of a text; null has none."""
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per source (one row each: source, source_size) the target size.

    Sources in code-point order, null last, take the weights in turn and share
    ``share`` times the total; what exceeds ``most`` times a source's size is
    reshared among the others by weight until none exceeds it: the sources with
    the smallest caps per weight are filled first, the rest have one level."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    caps = sizes.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * F.lit(most))
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    heavy = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    level = caps.withColumn("_level", left / heavy).withColumn("_full", F.col("_cap") / F.col("_weight") <= F.col("_level"))
    height = F.max(F.when(~F.col("_full"), F.col("_level"))).over(everything)
    return level.withColumn("target", F.when(F.col("_full"), F.col("_cap")).otherwise(height * F.col("_weight"))).select("source", "source_size", "target")


def _keyed(docs: DataFrame) -> DataFrame:
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    size = F.coalesce(F.col("size"), F.lit(0)).cast("long")
    return docs.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("name"), "source", size.alias("n_words"),
        F.length(F.bin(size)).alias("octave"), F.substring(digest, 1, 2).alias("part"), digest.alias("digest"), "doc_id", F.struct("*").alias("row"),
    )


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The documents (doc_id, source, size and any other columns) with
    source_size, target and copies, the times the mix takes the document; columns
    of these names are replaced."""
    keyed = _keyed(without(docs, "source_size", "target", "copies"))
    bucket = ["name", "octave", "part"]
    buckets = materialize(keyed.groupBy("source", *bucket).agg(F.sum("n_words").alias("n_words"), F.count("*").alias("n")), "mix-buckets")
    targets = source_targets(buckets.groupBy("source").agg(F.sum("n_words").alias("source_size")), weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT + 0.5)).otherwise(F.lit(0)).cast("long")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit("offset:"), F.coalesce("source", F.lit(""))).cast("binary")), 1, 6), 16, 10).cast("long")
    name = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))
    targets = targets.select(name.alias("name"), "source_size", "target", rate.alias("rate"), offset.alias("offset"))
    earlier = Window.partitionBy("name").orderBy("octave", "part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("n") * F.col("rate")).over(earlier), F.lit(0))
    placed = buckets.drop("source", "n_words").join(targets, "name").withColumn("start", before + F.col("offset"))
    inside = Window.partitionBy(*bucket).orderBy("digest", "doc_id", "n_words").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("start") + F.sum("rate").over(inside)
    taken = F.shiftright("end", 24) - F.shiftright(F.col("end") - F.col("rate"), 24)
    mixed = keyed.drop("source").join(placed.select(*bucket, "start", "rate", "source_size", "target"), bucket).withColumn("end", end)
    return mixed.select("row.*", "source_size", "target", taken.alias("copies"))


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         coalesce(CAST(doc_id AS VARCHAR), '') AS id_text
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
         source_size * 2.0::DOUBLE AS cap FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER f, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER f, 0)) AS lvl
  FROM weighed WINDOW f AS (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, CASE WHEN cap / w <= lvl THEN cap ELSE max(CASE WHEN cap / w > lvl THEN lvl END) OVER () * w END AS target FROM levels),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * 16777216 + 0.5) AS BIGINT) ELSE 0 END AS rate,
         CAST('0x' || substr(md5('offset:' || coalesce(source, '')), 1, 6) AS BIGINT) AS u FROM targets),
placed AS (
  SELECT s.doc_id, s.size, r.source_size, r.target, r.rate,
         u + rate * row_number() OVER (PARTITION BY s.source ORDER BY length(bin(s.size)), md5(id_text), s.doc_id, s.size) AS upto
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       CAST(((upto >> 24) - ((upto - rate) >> 24)) * size AS BIGINT) AS taken
FROM placed
"""
