"""Month-parameterised jobs: back-fill, scoring, publishing, vulnerability table."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelscore.functions import scoring
from panelscore.functions.months import months_back
from panelscore.operators import enrich, models, shape
from panelscore.sources import control, sinks
from panelscore.sources.tables import exists, month_slice, months_present


@dataclass(frozen=True)
class MonthResult:
    month: int
    rows: int
    ok: bool
    error: str | None = None


def run_months(months: Iterable[int], job: Callable[[int], int], workers: int = 1, spark: SparkSession | None = None,
               tag: str = "months", timeout: float | None = None) -> list[MonthResult]:
    """Run a job for each month; a failing month does not stop the others. Results are in order of the months.

    The job returns the rows it wrote.  Months without rows count as failed.

    With ``workers`` above 1 that many months run at a time, oldest first, in threads of their own; the session deals its
    executors among them. ``spark`` is needed then: the jobs of a month have the tags ``tag`` and ``tag-month``, by which
    ``cancel_months`` ends them, and so does ``timeout``, in seconds a month, which fails that month alone. Months of one
    table may be replaced at the same time: each write stages its files in a folder of its own.
    """
    months = sorted(int(x) for x in months)

    def one(m: int) -> MonthResult:
        try:
            n = job(m)
            return MonthResult(m, n, n > 0, None if n > 0 else "no rows")
        except Exception as e:  # one month must not take the others with it
            return MonthResult(m, 0, False, f"{type(e).__name__}: {e}")

    if workers == 1 and timeout is None:
        return [one(m) for m in months]
    if spark is None:
        raise ValueError("months that run at a time need the session")

    def tagged(m: int) -> MonthResult:
        spark.sparkContext.setInterruptOnCancel(True)  # of this thread: a cancelled task leaves its core at once
        for name in (tag, f"{tag}-{m}"):
            spark.sparkContext.addJobTag(name)
        clock = threading.Timer(timeout, cancel_months, (spark, tag, m)) if timeout else None
        try:
            if clock:
                clock.start()
            return one(m)
        finally:
            if clock:
                clock.cancel()
            for name in (tag, f"{tag}-{m}"):
                spark.sparkContext.removeJobTag(name)

    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(tagged, months))


def cancel_months(spark: SparkSession, tag: str = "months", month: int | None = None) -> None:
    """Ends the running Spark jobs of one month, or of all; their months fail, months not begun yet still run."""
    spark.sparkContext.cancelJobsWithTag(tag if month is None else f"{tag}-{int(month)}")


def results_frame(spark: SparkSession, results: Sequence[MonthResult]) -> DataFrame:
    return spark.createDataFrame([(r.month, r.rows, r.ok, r.error) for r in results],
                                 "month int, n_rows long, ok boolean, error string")


def backfill(build: Callable[[int], DataFrame], path: str, last: int, history: int,
             month: str = "month", workers: int = 1, spark: SparkSession | None = None) -> list[MonthResult]:
    """Build and replace ``last`` and the ``history`` months before it."""
    return run_months(months_back(last, history), lambda m: sinks.replace_month(build(m), path, m, month), workers, spark)


def rebuild_missing(spark: SparkSession, path: str, required: Sequence[int], build: Callable[[int], DataFrame],
                    month: str = "month", workers: int = 1) -> list[MonthResult]:
    """Find the required months without rows and rebuild everything between the first and the last."""
    if exists(spark, path):
        present = months_present(spark.read.parquet(path), month)
        months = control.rebuild_range(control.missing_months(present, required))
    else:
        months = sorted(required)
    return run_months(months, lambda m: sinks.replace_month(build(m), path, m, month), workers, spark)


def score_panel(panel: DataFrame, predict: Callable[[DataFrame], DataFrame], features: Sequence[str],
                calibration: tuple[float, float] | None = None, digits: int = 0) -> DataFrame:
    """Panel plus ``pd_raw, numpd, numxb, numscore`` (and ``xb_raw`` with a calibration).

    ``predict`` adds the column ``pd_raw``.  Without calibration numpd is the raw probability.
    """
    models.require_features(panel, features)
    scored = predict(panel)
    xb_raw = scoring.log_odds("pd_raw")
    if calibration is None:
        new: dict[str, Column] = {"numpd": F.col("pd_raw"), "numxb": xb_raw, "numscore": scoring.points(xb_raw, digits=digits)}
    else:
        xb = scoring.linear(xb_raw, *calibration)
        new = {"xb_raw": xb_raw, "numxb": xb, "numpd": scoring.inverse_logit(xb),
               "numscore": scoring.points(xb, digits=digits)}
    return scored.withColumns(new)


def score_months(panel: DataFrame, path: str, months: Sequence[int], predict: Callable[[DataFrame], DataFrame],
                 features: Sequence[str], calibration: tuple[float, float] | None = None,
                 month: str = "month") -> list[MonthResult]:
    """Score each month of the panel and replace it in the score table."""
    def job(m: int) -> int:
        rows = month_slice(panel, month, m)
        return sinks.replace_month(score_panel(rows, predict, features, calibration), path, m, month)

    return run_months(months, job)


def score_summary(spark: SparkSession, path: str, score: str = "numscore", month: str = "month") -> DataFrame:
    """What a score table holds per month: rows, missing scores, smallest, largest and mean score."""
    return spark.read.parquet(path).groupBy(month).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col(score).isNull()).alias("n_null"), F.min(score).alias("min"),
        F.max(score).alias("max"), F.avg(score).alias("mean"))


def publish(scores: DataFrame, path: str, root: Mapping[str, tuple[str, str | None]], struct_name: str,
            field_types: Mapping[str, str] | None = None, month: str = "month", stamp: bool = True) -> DataFrame:
    """All months of a score table in the published layout, in one job; returns the verification.

    The result has one row per month: rows in the source, rows written, and whether they agree.
    """
    stamps = {"run_date": F.current_date(), "updated_at": F.current_timestamp()} if stamp else {}
    packed = shape.pack(scores, dict(root), struct_name, dict(field_types or {}), stamps)
    sinks.write_months(packed, path, month, "replace")
    expected = scores.groupBy(F.col(month).cast("int").alias(month)).agg(F.count("*").alias("n_source"))
    written = sinks.written_months(scores.sparkSession, path, month).withColumnRenamed("n_rows", "n_written")
    both = expected.join(written, month, "left").withColumn("n_written", F.coalesce("n_written", F.lit(0)))
    return both.withColumn("ok", F.when(F.col("n_source") == F.col("n_written"), 1).otherwise(0))


def vulnerability(accounts: DataFrame, scores: DataFrame, intercept: float, slope: float, party: str = "party",
                  month: str = "month", target: str = "target", level: str = "level",
                  null_band: str | None = None) -> DataFrame:
    """Customers of the account table with their recalibrated score and risk band (inner join).

    The level of a customer is the smallest one of its accounts, not an arbitrary one.
    """
    people = accounts.filter(F.col(party).isNotNull()).groupBy(month, party).agg(
        F.count("*").alias("n_accounts"), F.max(target).alias(target), F.min(level).alias(level))
    xb = scoring.linear(scoring.log_odds("numpd"), intercept, slope)
    pd_cal = scoring.inverse_logit(xb)
    scored = scores.select(month, party, "numpd", xb.alias("xb_cal"), pd_cal.alias("pd_cal"),
                           scoring.points(xb, digits=1).alias("points"),
                           scoring.risk_band(pd_cal, null_band=null_band).alias("band"))
    return people.join(scored, [month, party], "inner")


def staged_range(table: DataFrame, path: str, first: int, last: int, month: str = "month",
                 struct_candidates: Sequence[str] = ()) -> DataFrame:
    """Month range written once, structs flattened, read back: analysis starts from files."""
    rows = month_slice(table, month, first, last)
    if struct_candidates:
        rows = shape.flatten(rows, struct_candidates)
    return sinks.stage(rows, path, month)


def current_and_history(staged: DataFrame, current: int, month: str = "month") -> tuple[DataFrame, DataFrame]:
    """The current month, which must have rows, and everything before it."""
    now = month_slice(staged, month, current)
    if now.isEmpty():
        raise ValueError(f"no rows for month {current}")
    return now, staged.filter(F.col(month) < F.lit(int(current)))


def score_and_attach(master: DataFrame, scorer: Callable[[DataFrame], DataFrame], key: Sequence[str],
                     generated: str, out: str = "pd_raw") -> DataFrame:
    """Scorers that return a changed table: only the generated column is taken back to the master."""
    scored = scorer(master).withColumnRenamed(generated, out)
    return enrich.attach_generated(master, scored, key, [out])
