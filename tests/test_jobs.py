"""Sinks, control file and monthly jobs in fresh folders."""

import pytest
from pyspark.sql import functions as F

from panelscore import session
from panelscore.catalog import job_queries
from panelscore.catalog.mapping import portfolio
from panelscore.plans import business, jobs, retail
from panelscore.sources import control, sinks, tables


@pytest.fixture
def months(spark):
    return spark.createDataFrame([(m, i, float(i)) for m in (202411, 202412, 202501) for i in range(5)], "month int, k int, x double")


def counts(spark, path):
    return {r["month"]: r["n_rows"] for r in sinks.written_months(spark, path).collect()}


def test_replace_month_touches_no_other(spark, months, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_months(months, path, mode="all")
    assert sinks.replace_month(months.filter("month = 202412 AND k < 2"), path, 202412) == 2
    assert counts(spark, path) == {202411: 5, 202412: 2, 202501: 5}
    assert sinks.replace_month(months.filter("month = 202412 AND k < 0"), path, 202412) == 0
    assert counts(spark, path) == {202411: 5, 202501: 5}


def test_replace_month_rejects_other_months(spark, months, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_months(months, path, mode="all")
    with pytest.raises(Exception):
        sinks.replace_month(months.filter("month >= 202412").withColumn("x", F.lit(0.0)), path, 202412)
    assert spark.read.parquet(path).agg(F.sum("x")).first()[0] == 30.0


def test_writes_are_observed(spark, months, tmp_path):
    from pyspark.sql import Observation
    path, seen = str(tmp_path / "t"), Observation()
    sinks.write_months(months, path, observed=seen)
    assert seen.get == {"n_rows": 15, "first_month": 202411, "last_month": 202501, "n_null_month": 0}
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    assert sinks.replace_month(months.filter("month = 202412"), path, 202412) == 5
    # the write with the shuffle before it, and nothing that reads the month again
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before <= 3


def test_months_at_a_time(spark, months, tmp_path):
    path = str(tmp_path / "t")
    spread = spark.range(600).select((F.col("id") % 6 + 202501).cast("int").alias("month"), "id")

    def job(m):
        rows = tables.month_slice(spread, "month", m)
        if m == 202503:
            rows = rows.withColumn("id", F.raise_error(F.lit("broken")).cast("long"))
        return sinks.replace_month(rows, path, m)

    wanted = [202506, 202501, 202503, 202502, 202505, 202504, 202509]
    serial = jobs.run_months(wanted, job)
    assert [(r.month, r.rows, r.ok) for r in serial] == [
        (202501, 100, True), (202502, 100, True), (202503, 0, False), (202504, 100, True), (202505, 100, True),
        (202506, 100, True), (202509, 0, False)]
    first = counts(spark, path)
    path = str(tmp_path / "u")
    together = jobs.run_months(wanted, job, workers=4, spark=spark)
    assert [(r.month, r.rows, r.ok) for r in together] == [(r.month, r.rows, r.ok) for r in serial]
    assert counts(spark, path) == first and "broken" in together[2].error
    with pytest.raises(ValueError):
        jobs.run_months(wanted, job, workers=4)


def test_a_slow_month_is_cancelled_alone(spark):
    def job(m):
        rows = spark.range(100, numPartitions=1)
        if m == 202502:
            import time
            rows = rows.mapInPandas(lambda batches: (time.sleep(40) or b for b in batches), "id long")
        return rows.count()

    found = jobs.run_months([202501, 202502, 202503], job, workers=2, spark=spark, timeout=15)
    assert [r.ok for r in found] == [True, False, True]


def test_write_modes_and_schema_drift(spark, months, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_months(months, path, mode="all")
    sinks.write_months(months.filter("month = 202501"), path, mode="append")
    assert counts(spark, path)[202501] == 10
    sinks.write_months(months.filter("month = 202501"), path, mode="replace")
    assert counts(spark, path) == {202411: 5, 202412: 5, 202501: 5}
    with pytest.raises(ValueError):
        sinks.write_months(months.withColumn("x", F.col("x").cast("string")), path)
    with pytest.raises(ValueError):
        sinks.write_months(months.drop("x"), path)
    with pytest.raises(ValueError):
        sinks.write_months(months.withColumn("y", F.lit(1)), path, allow_new_columns=False)
    sinks.write_months(months.filter("month = 202501").withColumn("y", F.lit(1)), path)
    assert "y" in tables.read_folders(spark, [path]).columns


def test_other_format(spark, months, tmp_path):
    path = str(tmp_path / "o")
    for _ in range(2):
        sinks.write_months(months, path, fmt="orc")
    assert tables.read_table(spark, path, "orc").count() == 15


def test_chunks(spark, months, tmp_path):
    path = str(tmp_path / "c")
    sinks.export_chunks(months, path, rows_per_file=1)
    assert spark.read.parquet(path).count() == 15
    assert len(list((tmp_path / "c" / "month=202501").glob("*.parquet"))) == 5


def test_metrics_and_views(spark, months, tmp_path):
    sinks.write_metrics({"rows": months.groupBy("month").count()}, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m" / "rows")).count() == 3
    sinks.register({"panel_view": months})
    assert spark.sql("SELECT count(*) FROM panel_view").first()[0] == 15
    sinks.unregister(spark, ["panel_view"])
    assert not spark.catalog.tableExists("panel_view")


def test_read_tables(spark, months, tmp_path):
    csv, folder = str(tmp_path / "x.csv"), str(tmp_path / "p")
    months.write.option("header", "true").option("sep", ";").csv(csv)
    months.write.parquet(folder)
    assert tables.read_table(spark, csv, "csv", sep=";", columns=["k", "x"]).columns == ["k", "x"]
    assert tables.select_sql(spark, months, "SELECT k FROM {source} WHERE month = 202501").count() == 5
    assert tables.read_folders(spark, [folder, folder]).count() == 30
    assert tables.exists(spark, folder) and not tables.exists(spark, folder + "x") and not tables.exists(spark, "no_table")
    assert tables.verify_table(spark, folder, ["K"]).count() == 15
    for args in ((folder + "x", []), (folder, ["zz"])):
        with pytest.raises(ValueError):
            tables.verify_table(spark, *args)
    assert tables.probe(months, 2)["count"] == 15
    assert [r["column"] for r in tables.describe(months).collect()] == ["month", "k", "x"]


def test_control_file(spark, months, tmp_path):
    f = tmp_path / "control.csv"
    f.write_text("APP,TABLA,CAMPO,DESFASE\nA,one,month,0\nA,two,month,-1\n")
    control_rows = control.read_control(spark, str(f))
    assert [(r.table, r.lag) for r in control_rows] == [("one", 0), ("two", -1)]
    report = control.availability(control_rows, lambda _: months, 202502)
    assert {r["table_name"]: r["available"] for r in report.collect()} == {"one": 0, "two": 1}
    with pytest.raises(ValueError):
        control.require_available(report)
    control.require_available(control.availability(control_rows, lambda _: months, 202501))


def test_backfill_isolates_failures(spark, months, tmp_path):
    path = str(tmp_path / "b")

    def build(m):
        if m == 202412:
            raise RuntimeError("broken source")
        return months.filter(F.col("month") == m)

    got = jobs.backfill(build, path, 202502, 3)
    assert [(r.month, r.rows, r.ok) for r in got] == [(202411, 5, True), (202412, 0, False), (202501, 5, True), (202502, 0, False)]
    assert "broken source" in got[1].error and jobs.results_frame(spark, got).count() == 4
    assert counts(spark, path) == {202411: 5, 202501: 5}
    again = jobs.rebuild_missing(spark, path, [202411, 202412, 202501], lambda m: months.filter(F.col("month") == m))
    assert [r.month for r in again] == [202412]
    assert counts(spark, path) == {202411: 5, 202412: 5, 202501: 5}


def test_publish(spark, months, tmp_path):
    path = str(tmp_path / "pub")
    check = jobs.publish(months, path, {"id": ("k", "string"), "month": ("month", "int")}, "vars")
    assert all(r["ok"] == 1 for r in check.collect())
    df = spark.read.parquet(path)
    assert set(df.columns) == {"id", "run_date", "updated_at", "vars", "month"}
    jobs.publish(months.filter("month = 202501"), path, {"id": ("k", "string"), "month": ("month", "int")}, "vars")
    assert counts(spark, path) == {202411: 5, 202412: 5, 202501: 5}


def test_score_job(spark, months, tmp_path):
    path = str(tmp_path / "s")
    got = jobs.score_months(months, path, [202412, 202501, 209901], lambda d: d.withColumn("pd_raw", F.lit(0.2)), ["x"], (-0.5, 0.9))
    assert [r.ok for r in got] == [True, True, False]
    r = spark.read.parquet(path).first()
    assert r["numxb"] == pytest.approx(-0.5 + 0.9 * r["xb_raw"]) and r["numpd"] < 0.2
    raw = jobs.score_panel(months, lambda d: d.withColumn("pd_raw", F.lit(0.2)), ["x"]).first()
    assert raw["numpd"] == 0.2
    kept = jobs.score_and_attach(months, lambda d: d.select("month", "k", F.lit(0.3).alias("P_1")), ["month", "k"], "P_1")
    assert kept.columns == ["month", "k", "x", "pd_raw"] and kept.filter("pd_raw = 0.3").count() == 15


def test_staging_and_split(spark, months, tmp_path):
    packed = months.select("month", F.struct("k", "x").alias("vars"))
    staged = jobs.staged_range(packed, str(tmp_path / "st"), 202412, 202501, struct_candidates=["vars"])
    now, before = jobs.current_and_history(staged, 202501)
    assert (now.count(), before.count(), set(now.columns)) == (5, 5, {"month", "k", "x"})
    with pytest.raises(ValueError):
        jobs.current_and_history(staged, 202511)


class _Bare:
    """A cluster's session without the shared-folder setting."""

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default


def test_checkpoint_folder(spark, months, tmp_path):
    with pytest.raises(ValueError):
        session.shared_dir(_Bare)
    assert session.shared_dir(_Bare, "/base/") == "/base"
    assert session.new_folder(_Bare, "x", "/base/").startswith("/base/x-")
    assert session.cut_lineage(months, str(tmp_path / "cp")).count() == 15


def test_retail_months_one_by_one_equal_the_range(spark, sf_dir):
    feat = job_queries.feature_table(spark, sf_dir)
    p, t = job_queries.retail_portfolio(spark, sf_dir), job_queries.retail_tables(spark, feat)
    arrears = (portfolio(spark, sf_dir).groupBy("month", F.col("party").cast("string").alias("party_id"))
               .agg(F.max("maturity").alias("max_days_past_due")))
    whole = retail.build(p, t, arrears, 199512, 199602)
    assert whole.columns == retail.KEYS + retail.FEATURES
    single = retail.build(p, t, arrears, 199601)
    assert sorted(map(repr, whole.filter("month = 199601").collect())) == sorted(map(repr, single.collect()))
    assert single.count() > 0
    everybody = retail.build(p, t, arrears, 199601, one_per_unique=False)
    assert everybody.count() >= single.count()
    with pytest.raises(ValueError):
        retail.feature_sources({}, 199601, 199601)


def test_business_month_equals_the_range(spark, sf_dir):
    feat = job_queries.feature_table(spark, sf_dir)
    t = job_queries.business_tables(spark, sf_dir, feat)
    whole = business.build(t, 199601, 199602).filter("month = 199602")
    single = business.build(t, 199602, unique_roles=business.READERS)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, single.collect()))
    assert single.columns == business.KEYS + business.FEATURES and single.count() > 0
