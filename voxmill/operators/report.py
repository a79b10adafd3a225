"""Descriptive reports. Durations are whole milliseconds until the last step, so that sums are exact in any order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Upper bounds in ms and names of the duration buckets, right-open.
BUCKETS = ((500, "<0.5s"), (1000, "0.5-1s"), (2000, "1-2s"), (3000, "2-3s"), (5000, "3-5s"), (10_000, "5-10s"), (15_000, "10-15s"), (30_000, "15-30s"), (None, ">=30s"))


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def stats(value: Column, scale: float = 1.0) -> list[Column]:
    """mean, median, population std, min, max, p25, p75, p90 of a number divided by scale; zeros without rows.

    Exact percentiles keep the distinct values of a column: whole milliseconds or lengths, of which there are few.
    """
    x = value / scale
    q = {"median": 0.5, "p25": 0.25, "p75": 0.75, "p90": 0.9}
    out = {"mean": F.avg(value) / scale, "std": F.stddev_pop(x), "min": F.min(x), "max": F.max(x)} | {k: F.percentile(value, p) / scale for k, p in q.items()}
    return [F.round(_or_zero(c), 6).alias(k) for k, c in out.items()]


def duration_stats(seg: DataFrame, *keys: str) -> DataFrame:
    """Count, seconds, minutes and stats of duration_ms, over all rows or by keys."""
    total = F.coalesce(F.sum("duration_ms"), F.lit(0))
    return seg.groupBy(*keys).agg(F.count("*").alias("n"), (total / 1000).alias("total_seconds"), F.round(total / 60_000, 6).alias("total_minutes"), *stats(F.col("duration_ms"), 1000.0))


def text_stats(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"), *stats(F.length("text").cast("long")))


def histogram(seg: DataFrame) -> DataFrame:
    """(ordinal, bucket, n) of all nine buckets, empty ones too."""
    ordinal = F.lit(len(BUCKETS) - 1)
    for i in reversed(range(len(BUCKETS) - 1)):
        ordinal = F.when(F.col("duration_ms") < BUCKETS[i][0], i).otherwise(ordinal)
    counts = seg.groupBy(ordinal.cast("long").alias("ordinal")).agg(F.count("*").alias("n"))
    names = seg.sparkSession.createDataFrame([(i, name) for i, (_, name) in enumerate(BUCKETS)], "ordinal long, bucket string")
    return names.join(counts, "ordinal", "left").select("ordinal", "bucket", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def totals(seg: DataFrame, *keys: str) -> DataFrame:
    """n, total_ms, minutes (2 places) and mean seconds by keys."""
    return seg.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("duration_ms").alias("total_ms")).withColumns({"minutes": F.round(F.col("total_ms") / 60_000, 2), "mean_seconds": F.round(F.col("total_ms") / F.col("n") / 1000, 6)})


def overlap_summary(seg: DataFrame, *keys: str) -> DataFrame:
    """Rows, overlapped rows, all and overlapped time and its share in percent, over all rows or by keys; seg has is_overlap."""
    over = F.sum(F.when(F.col("is_overlap"), F.col("duration_ms")).otherwise(0))
    out = seg.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if("is_overlap").alias("n_overlap"), F.coalesce(F.sum("duration_ms"), F.lit(0)).alias("total_ms"), F.coalesce(over, F.lit(0)).alias("overlap_ms"))
    return out.withColumn("overlap_pct", F.round(_or_zero(F.try_divide(F.col("n_overlap") * 100, "n")), 2))


def decisions(seg: DataFrame) -> DataFrame:
    """Counts of filter_decision, without null and empty ones."""
    return seg.where(F.coalesce("filter_decision", F.lit("")) != "").groupBy("filter_decision").agg(F.count("*").alias("n"))


def label_distribution(seg: DataFrame) -> DataFrame:
    """n and total_ms by speaker with the rank that reports show them in: TARGET, OTHER_*, the others by name, UNKNOWN, UNCERTAIN."""
    s = F.col("speaker")
    group = F.when(s == "TARGET", 0).when(s.startswith("OTHER_"), 1).when(s == "UNKNOWN", 3).when(s == "UNCERTAIN", 4).otherwise(2)
    out = seg.groupBy("speaker").agg(F.count("*").alias("n"), F.sum("duration_ms").alias("total_ms"))
    return out.withColumn("position", F.row_number().over(W.orderBy(group, "speaker")).cast("long"))  # one row a label


def overall(seg: DataFrame) -> DataFrame:
    return seg.agg(F.count("*").alias("n"), F.coalesce(F.sum("duration_ms"), F.lit(0)).alias("total_ms"), F.countDistinct("speaker").alias("n_speakers"), F.countDistinct("video_id").alias("n_videos"))


def longest(seg: DataFrame, n: int = 10) -> DataFrame:
    return seg.orderBy(F.desc("duration_ms"), "segment_id").limit(n)


def shortest(seg: DataFrame, n: int = 10) -> DataFrame:
    """The last n of the descending list, of which rows without duration then go; so they may be fewer."""
    return seg.orderBy(F.asc("duration_ms"), F.desc("segment_id")).limit(n).where("duration_ms > 0")


def funnel(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: how many segments, TARGET segments and minutes are left; no row if there were none, 0 percent for a base of 0.

    The TARGET share divides all rows that are left by the TARGET rows before, as only those pass.
    """
    b = before.agg(F.count("*").alias("n_before"), F.coalesce(F.sum("duration_ms"), F.lit(0)).alias("ms_before"), F.count_if(F.col("speaker") == "TARGET").alias("target_before"))
    a = after.agg(F.count("*").alias("n_after"), F.coalesce(F.sum("duration_ms"), F.lit(0)).alias("ms_after"))

    def pct(x: str, y: str) -> Column:
        return F.round(_or_zero(F.try_divide(F.col(x) * 100.0, y)), 2)

    both = b.crossJoin(a).where("n_before > 0")  # one row with one row
    return both.withColumns({"segments_pct": pct("n_after", "n_before"), "duration_pct": pct("ms_after", "ms_before"), "minutes_lost": F.round((F.col("ms_before") - F.col("ms_after")) / 60_000, 2), "target_pct": pct("n_after", "target_before")})


def tally(df: DataFrame, status: str = "status") -> DataFrame:
    """One row: total, succeeded, failed, skipped rows and the share that succeeded."""
    s = F.col(status)
    return df.agg(F.count("*").alias("total"), F.count_if(s == "success").alias("success"), F.count_if(s == "failed").alias("failed"), F.count_if(s == "skipped").alias("skipped")).withColumn("success_pct", F.round(_or_zero(F.try_divide(F.col("success") * 100.0, "total")), 2))


def require_success(df: DataFrame, status: str = "status") -> None:
    """Raise if there were no rows or none succeeded."""
    row = tally(df, status).first()
    if not row["total"]:
        raise ValueError("no input")
    if not row["success"]:
        raise ValueError(f"none of {row['total']} succeeded")
