"""Golden micro-tables for the column expressions."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panelscore.functions import cleaning, features, months, scoring


def one(spark, expr, **values):
    """Value of an expression over a single row; values are (python value, type) pairs."""
    row = spark.range(1).select(*[F.lit(v).cast(t).alias(k) for k, (v, t) in values.items()])
    return row.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("month,n,want", [(202512, 1, 202601), (202601, -1, 202512), (202506, 12, 202606),
                                          (202506, -12, 202406), (202511, 2, 202601), (202501, 0, 202501)])
def test_shift_month(spark, month, n, want):
    assert months.add_months(month, n) == want
    assert one(spark, months.shift_month("m", n), m=(month, "int")) == want


def test_shift_is_reversible_and_rejects_bad_keys(spark):
    df = spark.createDataFrame([(m,) for m in months.month_list(199001, 203012)], "m int")
    for n in (-13, -1, 5, 12, 37):
        back = df.select("m", months.shift_month(months.shift_month("m", n), -n).alias("b"))
        assert back.filter("m <> b OR b IS NULL").count() == 0
    assert one(spark, months.shift_month("m", 1), m=(202513, "int")) is None
    assert one(spark, months.shift_month("m", 1), m=(None, "int")) is None


def test_month_lists():
    assert months.month_list(202511, 202602) == [202511, 202512, 202601, 202602]
    assert months.months_back(202602, 2) == [202512, 202601, 202602]
    assert months.month_list(202602, 202601) == []


@pytest.mark.parametrize("text,want", [("2025-03-01", 202503), ("202503", 202503), (" 2025-12 ", 202512),
                                       ("x", None), (None, None), ("202513", None)])
def test_parse_month(spark, text, want):
    assert one(spark, months.parse_month("t"), t=(text, "string")) == want


@pytest.mark.parametrize("a,b,want", [
    (None, None, 44444444444), (None, 0, 6666666666), (None, 5, 1111111111), (None, -5, -1111111111),
    (0, None, 7777777777), (0, 0, 5555555555), (5, None, 2222222222), (-5, None, -2222222222),
    (5, 0, 3333333333), (-5, 0, -3333333333), (0, 5, 0), (1, 3, 0.33333333), (-2, 3, -0.66666667)])
@pytest.mark.parametrize("kind", ["double", "int", "decimal(18,2)"])
def test_ratio_with_sentinels(spark, a, b, want, kind):
    got = one(spark, features.ratio_with_sentinels("a", "b"), a=(a, kind), b=(b, kind))
    assert float(got) == want


def test_ratio_overflow_is_null(spark):
    assert one(spark, features.ratio_with_sentinels("a", "b"), a=(1e18, "double"), b=(1e-3, "double")) is None


def test_plain_ratio_does_not_raise(spark):
    assert one(spark, features.plain_ratio("a", "b"), a=(1.0, "double"), b=(0.0, "double")) is None


def test_sentinels_by_type(spark):
    rows = [(1111111111, 99999.0, "99999", 5), (7, 44444.4444, "x", 99999), (44444444444, 1.5, None, -99), (None, None, "", None)]
    df = (spark.createDataFrame(rows, "l long, d double, s string, i int")
          .withColumn("c", F.col("d").cast("decimal(19,8)")).withColumn("f", F.col("d").cast("float")))
    retail = cleaning.null_sentinels(df).collect()
    assert [r["l"] for r in retail] == [None, 7, None, None]
    assert [r["d"] for r in retail] == [None, 44444.4444, 1.5, None]
    assert [r["s"] for r in retail] == ["99999", "x", None, ""]
    assert [r["i"] for r in retail] == [5, None, -99, None]
    assert retail[0]["c"] is None and retail[0]["f"] is None
    business = cleaning.null_sentinels(df, cleaning.BUSINESS_SENTINELS)
    got = business.collect()
    assert got[1]["d"] is None and got[1]["c"] is None and got[1]["f"] is None and got[2]["i"] is None
    assert got[0]["d"] == 99999.0
    assert cleaning.null_sentinels(business, cleaning.BUSINESS_SENTINELS).collect() == got


def test_sentinels_of_one_column_are_values_of_another(spark):
    df = spark.createDataFrame([(99999.0, 99999, "99999"), (1111111111.0, -99, "x"), (1.5, None, None)],
                               "price double, supp long, flag string")
    got = cleaning.null_sentinels(df, {"PRICE": [1111111111], "supp": [99999], "flag": [99999], "absent": [1]}).collect()
    assert [tuple(r) for r in got] == [(99999.0, None, "99999"), (None, -99, "x"), (1.5, None, None)]


def test_nan_and_fill(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, None)], "d double, i int")
    got = cleaning.fill_nulls(cleaning.nan_to_null(df), {"d": -1.0, "i": 0, "absent": 3}).collect()
    assert [tuple(r) for r in got] == [(-1.0, 1), (2.0, 0)]


@pytest.mark.parametrize("v,lo,hi,want", [(None, 1, 5, None), (0, 1, 5, 1), (1, 1, 5, 1), (3, 1, 5, 3), (5, 1, 5, 5),
                                          (9, 1, 5, 5), (-3, None, 5, -3), (9, 1, None, 9)])
def test_clip(spark, v, lo, hi, want):
    x = features.clip("v", lo, hi)
    assert one(spark, x, v=(v, "int")) == want
    assert one(spark, features.clip(x, lo, hi), v=(v, "int")) == want


def test_apply_clips_absent_column(spark):
    df = features.apply_clips(spark.range(1), [("nope", "nope_cap", 0, 1)])
    assert df.schema["nope_cap"].dataType.simpleString() == "double" and df.first()["nope_cap"] is None


@pytest.mark.parametrize("birth,want", [(None, None), (dt.date(2025, 3, 1), None), (dt.date(2025, 2, 28), 0),
                                        (dt.date(2000, 2, 28), 25), (dt.date(2000, 2, 29), 25),
                                        (dt.date(2000, 3, 1), 24), (dt.date(1999, 12, 31), 25)])
def test_age(spark, birth, want):
    assert one(spark, features.age_at_month_end("b", "m"), b=(birth, "date"), m=(202502, "int")) == want


def test_age_by_months(spark):
    assert one(spark, features.age_by_months("b", "m"), b=(dt.date(1990, 7, 1), "date"), m=(202501, "int")) == 35.0
    assert one(spark, features.age_by_months("b", "m"), b=(dt.date(2020, 7, 1), "date"), m=(202501, "int")) == 22.0
    assert one(spark, features.age_by_months("b", "m"), b=(None, "date"), m=(202501, "int")) is None


def test_text_max(spark):
    x = features.text_max("a", "b", "c")
    assert one(spark, x, a=("3", "string"), b=("NULL", "string"), c=("", "string")) == 3.0
    assert one(spark, x, a=(None, "string"), b=("null", "string"), c=("", "string")) is None
    assert one(spark, x, a=("-5", "string"), b=("-7.5", "string"), c=(None, "string")) == -5.0


@pytest.mark.parametrize("kind,want", [("1", 2.0), ("6", 9.0), (None, 9.0)])
def test_own_or_owner(spark, kind, want):
    got = one(spark, features.own_or_owner_max("k", "o", "w"), k=(kind, "string"), o=(2.0, "double"), w=(9.0, "double"))
    assert got == want


@pytest.mark.parametrize("cur,prev,want", [(None, None, None), (5, 3, 0), (3, 5, 2), (None, 4, 4), (4, None, 0), (3, 3, 0)])
def test_decreasing_variation(spark, cur, prev, want):
    assert one(spark, features.decreasing_variation("c", "p"), c=(cur, "int"), p=(prev, "int")) == want


@pytest.mark.parametrize("cur,rate,want", [("0001", None, 10.0), ("1001", 3.5, 35.0), ("1001", None, None), ("9", 2.0, None)])
def test_currency(spark, cur, rate, want):
    x = features.convert_currency("c", "a", "r")
    assert one(spark, x, c=(cur, "string"), a=(10.0, "double"), r=(rate, "double")) == want


@pytest.mark.parametrize("v,want", [(None, 0), (0, 0), (0.5, 0), (1, 2), (2, 2), (3, 4)])
def test_step_round(spark, v, want):
    assert one(spark, features.step_round("v"), v=(v, "double")) == want


def test_flags_and_categories(spark):
    assert one(spark, features.any_flag("a", "b"), a=(None, "string"), b=("1", "string")) == "1"
    assert one(spark, features.any_flag("a", "b"), a=(None, "string"), b=("0", "string")) == "0"
    assert one(spark, features.in_category("a", ["X"]), a=(None, "string")) == 1
    assert one(spark, features.in_category("a", ["X"]), a=("Y", "string")) == 0
    assert one(spark, features.flag_to_text("a"), a=(0.6, "double")) == "1"


@pytest.mark.parametrize("a,b,want", [(1.0, 1.0, 1), (1.0, 1.0000005, 1), (1.0, 1.1, 0), (None, None, 1), (None, 1.0, 0),
                                      (float("nan"), float("nan"), 0)])
def test_same_within(spark, a, b, want):
    assert one(spark, features.same_within("a", "b"), a=(a, "double"), b=(b, "double")) == want


@pytest.mark.parametrize("p,xb,pts", [(0.0, None, None), (1.0, None, None), (None, None, None), (0.5, 0.0, 174.0),
                                      (0.999999, math.log(0.999999 / 0.000001), 3.0)])
def test_scores(spark, p, xb, pts):
    got = one(spark, scoring.log_odds("p"), p=(p, "double"))
    assert got == xb or got == pytest.approx(xb, rel=1e-9)
    assert one(spark, scoring.points(scoring.log_odds("p")), p=(p, "double")) == pts


def test_inverse_logit_extremes(spark):
    assert one(spark, scoring.inverse_logit("x"), x=(800.0, "double")) == 1.0
    assert one(spark, scoring.inverse_logit("x"), x=(-800.0, "double")) == 0.0


@pytest.mark.parametrize("p,want", [(None, "high"), (0.019, "low"), (0.02, "watch"), (0.07, "high")])
def test_band(spark, p, want):
    assert one(spark, scoring.risk_band("p"), p=(p, "double")) == want
    if p is None:
        assert one(spark, scoring.risk_band("p", null_band="unknown"), p=(p, "double")) == "unknown"


@pytest.mark.parametrize("p,i", [(None, 0), (0.0, 1), (0.01, 2), (0.03, 3), (0.07, 4), (0.15, 5), (0.30, 6), (5.0, 6)])
def test_buckets(spark, p, i):
    assert one(spark, scoring.pd_bucket("p"), p=(p, "double")) == scoring.bucket_labels()[i]


def test_bucket_edges(spark):
    assert one(spark, scoring.pd_bucket("p"), p=(-0.1, "double")) == "C?"
    assert one(spark, scoring.pd_bucket("p", ()), p=(0.4, "double")) == scoring.bucket_labels(())[1]


def test_pairs_and_trim(spark):
    pairs = {"A": ["x"], "B": ["y", "z"]}
    for a, b, want in ((" A ", "x", True), ("A", "y", False), ("B", " z", True), (None, "x", None)):
        assert one(spark, features.any_pair("a", "b", pairs), a=(a, "string"), b=(b, "string")) is want
    assert one(spark, features.trimmed_in("a", ["q"]), a=(" q ", "string")) is True
