"""Summaries of tables and of job logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: millionths of a stage's target rate that count as met.
ATTAINED = 850_000


def logical_summary(bars: DataFrame) -> DataFrame:
    """Count, time bounds and exact sums of a table of bars, equal for equal contents in any layout."""
    sums = {"ids": "k", "opens": "open", "highs": "high", "lows": "low", "closes": "close", "volumes": "volume", "turnovers": "turnover"}
    return bars.agg(F.count("*").alias("n"), F.min("t").alias("first_t"), F.max("t").alias("last_t"), *[F.sum(c).alias(n) for n, c in sums.items()])


def value_distribution(bars: DataFrame) -> DataFrame:
    """Distinct closes, bounds, dynamic range in 1e-4, whole prices and significant decimals of each instrument (cents).

    An instrument whose least price is 0 has no dynamic range: null.
    """
    decimals = F.length(F.regexp_replace(F.lpad(F.pmod("close", F.lit(100)).cast("string"), 2, "0"), "0+$", "")).cast("long")
    return bars.groupBy("k").agg(
        F.countDistinct("close").alias("closes"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("volume").alias("min_volume"), F.max("volume").alias("max_volume"),
        F.min("turnover").alias("min_turnover"), F.max("turnover").alias("max_turnover"), F.expr("max(high) * 10000 div nullif(min(low), 0)").alias("dynamic_range"),
        F.count(F.when(F.pmod("close", F.lit(100)) == 0, 1)).alias("whole"), F.max(decimals).alias("places"))


def percentiles(rows: DataFrame, by: str, value: str) -> DataFrame:
    """Nearest-rank percentiles and bounds of value in each group."""
    ranks = [F.expr(f"percentile_disc({p}) within group (order by {value})").cast("long").alias(n) for p, n in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99"))]
    return rows.groupBy(by).agg(F.count("*").alias("n"), *ranks, F.min(value).alias("low"), F.max(value).alias("high"))


def stage_throughput(log: DataFrame) -> DataFrame:
    """Attempts, successes, errors, span and whole attempts a minute of each stage of a log (stage, t, kind)."""
    return log.groupBy("stage").agg(
        F.count("*").alias("attempts"), F.count(F.when(F.col("kind") != "error", 1)).alias("successes"), F.count(F.when(F.col("kind") == "error", 1)).alias("errors"),
        (F.max("t") - F.min("t")).alias("span_ms"), F.expr("count(*) * 60000 div greatest(max(t) - min(t), 1)").alias("per_minute"))


def stage_status(log: DataFrame, plans: DataFrame) -> DataFrame:
    """Of each planned stage (stage, planned, target attempts a minute): attempts, successes, rows and errors by code of a log
    (stage, t, code or null, rows), the part of the target that was met in millionths, and status.

    failed: attempts or successes fall short of the plan, or any error; under_target: less than ATTAINED of the target. A stage
    without a log has no attainment and has failed.
    """
    codes = log.filter(F.col("code").isNotNull()).groupBy("stage", "code").agg(F.count("*").alias("c"))
    codes = codes.groupBy("stage").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "code", F.col("c").cast("string")))), ",").alias("errors"))  # a row for each code
    good = F.col("code").isNull()
    sums = log.groupBy("stage").agg(F.count("*").alias("attempts"), F.count(F.when(good, 1)).alias("successes"), F.coalesce(F.sum(F.when(good, F.col("rows"))), F.lit(0)).alias("rows"),
                                    F.greatest(F.max("t") - F.min("t"), F.lit(1)).alias("span"))
    met = plans.join(sums, "stage", "left").join(codes, "stage", "left")
    met = met.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("attempts", "successes", "rows")} | {"errors": F.coalesce("errors", F.lit("")), "attainment": F.expr("attempts * 60000000000 div (span * target)")})
    failed = (F.col("attempts") != F.col("planned")) | (F.col("successes") != F.col("planned")) | (F.col("errors") != "")
    status = F.when(failed, "failed").when(F.col("attainment") >= ATTAINED, "passed").otherwise("under_target")
    return met.select("stage", "planned", "attempts", "successes", "rows", "errors", "attainment", status.alias("status"))


def backfill_estimate(life: DataFrame, start_ms: int, end_ms: int, page: int = 1000, cadence: int = 480) -> DataFrame:
    """Minutes of each lifecycle (k, launch, last) inside a horizon, with pages and settlements, rounded up."""
    minutes = F.greatest(F.floor((F.least(F.col("last"), F.lit(end_ms)) - F.greatest(F.col("launch"), F.lit(start_ms))) / 60_000) + 1, F.lit(0))
    sized = life.withColumn("minutes", minutes)
    return sized.select("k", "minutes", F.ceil(F.col("minutes") / page).alias("pages"), F.ceil(F.col("minutes") / cadence).alias("events"))


def storage_projection(sizes: DataFrame, rows: int, free: int) -> DataFrame:
    """Bytes that `rows` rows take at each group's bytes for each row, exact and rounded up, and whether they fit."""
    exact = F.expr(f"cast((cast(bytes as decimal(28,0)) * {rows} + n - 1) div n as bigint)")
    return sizes.select("bucket", "n", "bytes", exact.alias("projected"), (exact <= free).alias("fits"))


def progress(jobs: DataFrame, lookback_ms: int) -> DataFrame:
    """Complete and total jobs of each campaign, millionths, recent rate, and seconds left at that rate, rounded up."""
    now = jobs.agg(F.max("t").alias("now"))
    counted = jobs.crossJoin(now).groupBy("campaign").agg(  # now is one row
        F.count("*").alias("total"), F.count(F.when(F.col("done"), 1)).alias("complete"), F.count(F.when(F.col("done") & (F.col("t") > F.col("now") - lookback_ms), 1)).alias("recent"))
    eta = F.when(F.col("recent") > 0, F.expr(f"((total - complete) * {lookback_ms // 1000} + recent - 1) div recent"))
    return counted.select("campaign", "total", "complete", F.expr("complete * 1000000 div total").alias("millionths"),
                          F.when(F.col("complete") == F.col("total"), "complete").otherwise("running").alias("status"), "recent", eta.alias("eta_s"))


def campaign_progress(jobs: DataFrame, finalized: DataFrame, now: int, window_ms: int) -> DataFrame:
    """Progress of each campaign at the time `now` and the seconds that its pending pages take at the recent rate.

    jobs: (campaign, job, pages, rows, started, completed), times null where unknown; a job that completes after `now` is
    pending. finalized: (campaign) of those whose aggregate is signed off; to be so with pending jobs is an error.
    status: complete, finalization-pending (every job done), in-progress or not-started. The rate counts pages of the jobs
    completed within the window but the first, over the time since that one; a lone job counts its own pages over its own
    time. Without a rate eta_s is null, without pending pages 0. One aggregation: a campaign with most of the jobs is
    summed up before the shuffle.
    """
    at = F.when(F.col("completed") <= now, F.col("completed"))
    seen = jobs.select("campaign", "job", "pages", "rows", "started", at.alias("completed"))
    done, recent = F.col("completed").isNotNull(), F.col("completed") >= max(0, now - window_ms)
    first = F.min(F.when(recent, F.struct("completed", "job", "started", "pages")))
    sums = seen.groupBy("campaign").agg(
        F.count("*").alias("jobs"), F.count("completed").alias("completed_jobs"), F.sum("pages").alias("pages"), F.coalesce(F.sum(F.when(done, F.col("pages"))), F.lit(0)).alias("completed_pages"),
        F.coalesce(F.sum(F.when(done, F.col("rows"))), F.lit(0)).alias("completed_rows"), F.max("completed").alias("last_completed"),
        F.count(F.when(recent, 1)).alias("recent_jobs"), F.sum(F.when(recent, F.col("pages"))).alias("recent_pages"), first.alias("first"))
    several = F.col("recent_jobs") >= 2
    own_time = F.coalesce(F.col("first.completed") - F.col("first.started"), F.lit(0))
    sums = sums.withColumns({
        "pending_pages": F.col("pages") - F.col("completed_pages"),
        "sample_jobs": F.when(several, F.col("recent_jobs") - 1).otherwise(F.col("recent_jobs")),
        "sample_pages": F.when(several, F.col("recent_pages") - F.col("first.pages")).otherwise(F.coalesce("recent_pages", F.lit(0))),
        "sample_ms": F.when(several, now - F.col("first.completed")).when(F.col("recent_jobs") == 1, own_time).otherwise(0)})
    sums = sums.withColumn("rate_milli", F.expr("case when sample_pages > 0 then sample_pages * 1000000 div nullif(sample_ms, 0) end"))
    eta = F.expr("case when pending_pages = 0 then 0 else (pending_pages * 1000 + rate_milli - 1) div nullif(rate_milli, 0) end")
    signed = finalized.select("campaign").distinct().withColumn("signed", F.lit(True))
    whole = F.col("completed_jobs") == F.col("jobs")
    status = (F.when(F.col("signed") & ~whole, F.raise_error(F.lit("a finalized campaign has pending jobs")).cast("string")).when(F.col("signed"), "complete")
              .when(whole, "finalization-pending").when(F.col("completed_jobs") > 0, "in-progress").otherwise("not-started"))
    return sums.join(signed, "campaign", "left").select(
        "campaign", "jobs", "completed_jobs", "pages", "completed_pages", "pending_pages", "completed_rows", "last_completed", F.expr(f"({now} - last_completed) div 1000").alias("age_s"),
        F.expr("completed_pages * 1000000 div nullif(pages, 0)").alias("millionths"), status.alias("status"), "sample_jobs", "sample_pages", "sample_ms", "rate_milli", eta.alias("eta_s"))


def progress_total(campaigns: DataFrame) -> DataFrame:
    """One row over campaign_progress(): sums, millionths of all pages, and the seconds of the critical path.

    Campaigns run side by side, so eta_s is the longest of those not complete; null if one of them has none, 0 if all are complete.
    """
    pending = F.col("status") != "complete"
    sums = campaigns.agg(
        F.count("*").alias("campaigns"), F.count(F.when(pending, 1)).alias("pending_campaigns"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("jobs", "completed_jobs", "pages", "completed_pages", "pending_pages")],
        F.count(F.when(pending, F.col("eta_s"))).alias("known"), F.max(F.when(pending, F.col("eta_s"))).alias("longest"))
    eta = F.when(F.col("pending_campaigns") == 0, 0).when(F.col("known") == F.col("pending_campaigns"), F.col("longest"))
    return sums.select(*[c for c in sums.columns if c not in ("known", "longest")], F.expr("completed_pages * 1000000 div nullif(pages, 0)").alias("millionths"), eta.alias("eta_s"))


def shortlist_layouts(runs: DataFrame, scans: list[str], buckets: tuple[int, ...] = (4, 8)) -> DataFrame:
    """The best layout of each bucket count and how many were eligible there; bucket counts without one have no row.

    runs: (buckets, numeric, compression, target_mb, verified, largest, bytes, write_ms, files, a column for each of `scans`).
    Eligible: the numeric schema is verified and the largest file but the tail has at least 80% of the target. Best: least
    bytes, then write time, sum of the scans' times, files, and the layout's own fields. A run that lacks a figure isn't eligible.
    """
    scan = reduce(Column.__add__, [F.col(c) for c in scans])
    figures = F.struct("bytes", "write_ms", scan.alias("scan_ms"), "files", "numeric", "compression", "target_mb")
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in ("bytes", "write_ms", "files", *scans)])
    eligible = F.col("verified") & (F.col("largest") * 10 >= F.col("target_mb") * 8 * 1024 * 1024) & known
    best = runs.filter(eligible & F.col("buckets").isin(*buckets)).groupBy("buckets").agg(F.count("*").alias("eligible"), F.min(figures).alias("best"))
    return best.select("buckets", "eligible", "best.*")
