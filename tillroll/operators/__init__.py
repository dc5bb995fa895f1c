"""Reusable DataFrame operators.

``top1_per_key`` is the one ranking operator behind every "latest",
"top" and "favourite" rule and behind de-duplication.  It is written as
``row_number() == 1`` so Catalyst turns it into a ``WindowGroupLimit``
that keeps one row per key *inside each map partition before the shuffle*
and again after it: a key that owns a third of all rows still sends at
most one row per input partition across the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import checkpoint_root

_RANK = "__tillroll_rank"


def _cols(items: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def top1_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep, for every value of ``keys``, the first row under ``order``.

    ``order`` must be a total order over the rows of one key (end it with a
    unique column, or with every remaining column) so the kept row does not
    depend on partitioning or task scheduling.  NULL placement must be
    explicit in every sort expression.
    """
    if not order:
        raise ValueError("top1_per_key needs a non-empty order")
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)


def dedup_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deterministic ``dropDuplicates(keys)``.

    Among rows sharing ``keys`` keep the smallest by all remaining columns
    in schema order, ascending, NULLs last.  Any row would be a valid
    ``dropDuplicates`` answer; fixing one makes reruns reproducible.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(c).asc_nulls_last() for c in rest] or [F.lit(0)]
    return top1_per_key(df, keys, order)


def first_by(value: Column | str, order: Sequence[Column]) -> Column:
    """Aggregate: ``value`` of the row that sorts first under ``order``.

    ``order`` is a list of ascending-comparable columns (negate a count for
    "largest first"; put ``isNull()`` before a nullable column for "NULLs
    last").  The top-1 is then one more aggregate in the same ``groupBy``
    (one shuffle, partial on the map side) instead of a separate window
    over a second copy of the rows.  The order must be total within a
    group (end it with a grouping-unique column)."""
    value = F.col(value) if isinstance(value, str) else value
    return F.min_by(value, F.struct(*_cols(order)))


#: Parts that all rows of a fact table would be cut into, for each shuffle partition.
SALTS = 2
#: A key with one of so many of the rows is heavy; the sketch tracks four times as many keys.
HEAVY_SHARE = 1000
_SALT = "__tillroll_salt"


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark broadcasts ``df`` as a join side by its own size statistics."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def heavy_keys(facts: DataFrame, key: str, parts: int, share: int = HEAVY_SHARE) -> Column:
    """Map from each heavy key of ``facts`` to the number of salts it is spread
    over, in proportion to its share of the rows: ``parts`` for a key with all.

    A frequent-items sketch (mergeable: one bounded summary for each map task,
    merged in one step) over the key column, as a scalar subquery: it holds fewer than
    ``share`` keys, however large the table."""
    top = facts.where(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k({key}, {share}, {4 * share})").alias("top"), F.count("*").alias("n"))
    salts = lambda e: F.ceil(e["count"] * F.lit(parts) / F.col("n")).cast("int")
    heavy = F.filter("top", lambda e: e["item"].isNotNull() & (e["count"] * F.lit(share) > F.col("n")) & (salts(e) > 1))
    return top.select(F.map_from_entries(F.transform(heavy, lambda e: F.struct(e["item"], salts(e))))).scalar()


def salted_join(facts: DataFrame, dimension: DataFrame, key: str, spread_by: str, how: str = "left", keep_salt: bool = False,
                sketched: DataFrame | None = None) -> DataFrame:
    """``facts`` joined to ``dimension`` (one row for each ``key``); no key meets one task.

    Where Spark broadcasts the dimension, nothing is salted.  Else the keys that a sketch of
    the facts finds heavy are spread by a hash of ``spread_by`` over salts in
    proportion to their share, and only their dimension rows are copied; other
    keys have one salt.  A part of a heavy key is about half of a mean
    shuffle partition, so the largest task keeps its share of the rows as both
    grow.  Facts with a NULL key, which join nothing, are spread like a key with
    all rows.  The result does not depend on the sketch.  AQE's skew split does
    not help here: the dimension comes out of its de-duplication without an
    exchange of its own.

    ``sketched`` is a table that holds the facts' keys in like shares and is
    cheaper to read than facts that come out of other joins.
    ``keep_salt`` keeps the salt column where there is one: the output is then
    partitioned on (key, salt)."""
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    if fits_broadcast(dimension):
        return facts.join(dimension, key, how)
    spark = facts.sparkSession
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    parts = SALTS * int(initial or spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys((facts if sketched is None else sketched).select(key), key, parts)
    salts = F.when(F.col(key).isNull(), F.lit(parts)).otherwise(F.coalesce(F.try_element_at(heavy, F.col(key)), F.lit(1)))
    salted = facts.withColumn(_SALT, F.when(salts > 1, F.pmod(F.xxhash64(spread_by), salts).cast("int")).otherwise(F.lit(0)))
    copies = dimension.where(F.col(key).isNotNull()).withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.try_element_at(heavy, F.col(key)), F.lit(1)) - 1)))
    joined = salted.join(copies, [key, _SALT], how)
    return joined if keep_salt else joined.drop(_SALT)


def salted_left_join(facts: DataFrame, dimension: DataFrame, key: str, spread_by: str, sketched: DataFrame | None = None) -> DataFrame:
    """``salted_join`` that keeps every fact row."""
    return salted_join(facts, dimension, key, spread_by, sketched=sketched)


def count_where(pred: Column) -> Column:
    """Number of rows where ``pred`` is true (NULL counts as false)."""
    return F.count_if(pred)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL (or, for floating columns, NaN) in any key —
    ``na.drop(how="any", subset=keys)``, written as plain predicates so that
    Catalyst records the keys as non-NULL: joins then infer no extra
    ``isnotnull`` filters, and the plans of two uses of one cleaned table
    stay identical (their shuffles are reused)."""
    types = dict(df.dtypes)
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        if types[k] in ("float", "double"):
            c = c & ~F.isnan(F.col(k))
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` with the place (from 1) of each row in the total order, no matter how large.

    A range exchange sorts the rows over all tasks.  Each row's number in its
    partition, plus the rows of the partitions before it, is its place: the
    only single step sums one count for each partition.  The sorted rows are
    written to the shared checkpoint folder first, so that the counts and the
    rows come from one division into partitions, also after a lost executor."""
    checkpoint_root(df.sparkSession)
    number, part = "__tillroll_number", "__tillroll_part"
    # the id of a row: its partition in the upper 31 bits, its number in it below
    placed = df.orderBy(*order).withColumn(number, F.monotonically_increasing_id()).checkpoint()
    placed = placed.withColumn(part, F.shiftright(number, 33)).withColumn(number, F.col(number).bitwiseAND(F.lit((1 << 33) - 1)))
    counts = placed.groupBy(part).agg(F.count("*").alias("__tillroll_rows"))
    before = F.sum("__tillroll_rows").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(part, F.coalesce(before, F.lit(0)).alias("__tillroll_before"))
    return placed.join(offsets, part).select(*df.columns, (F.col("__tillroll_before") + F.col(number) + 1).alias(name))
