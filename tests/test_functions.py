import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.functions import (
    clean_code,
    clean_text,
    growth_pct,
    money_mean,
    money_round,
    money_sum,
    money_total,
    money_value,
    parse_run_date,
    pct,
    round2,
    run_date_lit,
    to_day,
    to_double,
    to_int,
)


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_round2_is_half_up_on_the_shortest_decimal_form(spark):
    r = one(spark, round2(F.lit(1.005)).alias("a"), round2(F.lit(-1.005)).alias("b"),
            round2(F.lit(2.675)).alias("c"), round2(F.lit(0.125)).alias("d"),
            round2(F.lit(4478935.06) / 4).alias("e"), round2(F.lit(3) * F.lit(1.005)).alias("f"),
            round2(F.lit(float("nan"))).alias("g"), round2(F.lit(None).cast("double")).alias("h"))
    # 4478935.06 / 4 prints as 1119733.765; 3 * 1.005 prints as 3.0149999999999997
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.h) == (1.01, -1.01, 2.68, 0.13, 1119733.77, 3.01, None)
    assert r.g != r.g  # NaN stays NaN, as with round()


def test_pct_and_growth(spark):
    r = one(spark, pct(F.lit(1), F.lit(3)).alias("p"), pct(F.lit(1), F.lit(0)).alias("z"),
            growth_pct(F.lit(150.0), F.lit(100.0)).alias("g"), growth_pct(F.lit(1.0), F.lit(0.0)).alias("g0"),
            growth_pct(F.lit(1.0), F.lit(None).cast("double")).alias("gn"),
            growth_pct(F.lit(1.0), F.lit(-5.0)).alias("gneg"))
    assert (r.p, r.z, r.g, r.g0, r.gn, r.gneg) == (33.33, None, 50.0, None, None, None)


def test_lenient_parsing(spark):
    r = one(
        spark,
        to_int(F.lit("3.7")).alias("a"), to_int(F.lit("1e30")).alias("b"), to_int(F.lit("abc")).alias("c"),
        to_int(F.lit(5)).alias("d"), to_double(F.lit("n/a")).alias("e"), to_double(F.lit("12.50")).alias("f"),
        to_day(F.lit("2019-03-04 10:11:12")).alias("g"), to_day(F.lit("garbage")).alias("h"),
        to_day(F.lit("2019-03-04T23:59:59.000")).alias("i"),
    )
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == (3, None, None, 5, None, 12.5)
    assert (r.g, r.h, r.i) == (dt.date(2019, 3, 4), None, dt.date(2019, 3, 4))


def test_trim_keeps_tabs_and_lower(spark):
    r = one(spark, clean_text(F.lit("\t a \t")).alias("a"), clean_text(F.lit("  b ")).alias("b"),
            clean_code(F.lit(" Completed ")).alias("c"))
    assert (r.a, r.b, r.c) == ("\t a \t", "b", "completed")


def test_money_sum_is_exact_and_order_independent(spark):
    vals = [0.1] * 10 + [0.2] * 5 + [1e6 + 0.005]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = df.repartition(7).agg(money_sum("x").alias("s"), F.count("x").alias("n")).first()
    b = df.coalesce(1).agg(money_sum("x").alias("s"), F.count("x").alias("n")).first()
    assert a.s.exact == b.s.exact == Decimal("1000002.005") and not a.s.inexact
    r = df.agg(money_sum("x").alias("s"), F.count("x").alias("n")).select(money_mean("s", "n").alias("avg"), money_round("s").alias("sum")).first()
    assert (r.avg, r.sum) == (round(1000002.005 / 16, 2), 1000002.01)


@pytest.mark.parametrize("odd, want", [(float("nan"), float("nan")), (float("inf"), float("inf")), (float("-inf"), float("-inf")),
                                       (1e20, 1e20 + 10.25), (3e20, 3e20 + 10.25), (None, 10.25)])
def test_no_amount_is_left_out_of_a_sum(spark, odd, want):
    """Values without an exact decimal form give the plain double sum, in one level and in two, and the mean divides it by the same rows."""
    df = spark.createDataFrame([(1, 10.0), (1, odd), (2, 0.25), (3, None)], "k int, x double")
    same = lambda a, b: a == b or (a != a and b != b)
    one_level = df.agg(money_sum("x").alias("s"), F.count("x").alias("n"))
    two_level = df.groupBy("k").agg(money_sum("x").alias("s"), F.count("x").alias("n")).agg(money_total("s").alias("s"), F.sum("n").alias("n"))
    for agg in (one_level, two_level):
        r = agg.select(money_value("s").alias("v"), money_round("s").alias("r"), money_mean("s", "n").alias("m")).first()
        assert same(r.v, want) and same(r.r, want)
        assert same(r.m, want / 3 if odd is not None else 5.13)


def test_overflow_of_the_exact_sum_is_no_partial_sum(spark):
    df = spark.createDataFrame([(i % 3, 9e19) for i in range(9)], "k int, x double")
    two = df.groupBy("k").agg(money_sum("x").alias("s")).agg(money_total("s").alias("s")).select(money_value("s").alias("v")).first()
    assert two.v == pytest.approx(81e19)
    assert df.limit(0).agg(money_sum("x").alias("s")).select(money_value("s").alias("v")).first().v is None


def test_run_date_validation(spark):
    assert parse_run_date("20011231") == dt.date(2001, 12, 31)
    for bad in ["2001-12-31", "20011332", "", "2001123"]:
        with pytest.raises(ValueError):
            parse_run_date(bad)
    assert one(spark, run_date_lit("20240229").alias("d")).d == dt.date(2024, 2, 29)
