"""Time-ordered pieces of bounded size, so that a series with much of all rows isn't one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def chunked(df: DataFrame, keys: list[str], us: str, size: int, halo: int, bucket_s: int = 3600) -> DataFrame:
    """Add ``chunk``, ``core`` and ``n_total``: each series cut into chunks of about ``size`` rows in time order.

    Every row is the core of exactly one chunk. A chunk also holds at least the ``halo`` rows before and behind its core
    (``core`` false), as far as the series has them, so an operator that looks at most ``halo`` rows away sees the same
    neighbours as on the whole series. Cuts lie between buckets of ``bucket_s`` seconds, so a chunk exceeds ``size`` by at
    most one bucket. ``n_total`` is the number of rows of the series. Rows with a null time are dropped.

    Scale: the plan of the cuts comes from counts per bucket (aggregated on the map side), not from rows; its windows
    run over buckets only. Rows then shuffle once by (keys, chunk) when the caller groups them.
    """
    rows = df.filter(F.col(us).isNotNull()).withColumn("_bucket", F.floor(F.col(us) / F.lit(bucket_s * 1_000_000)))
    counts = rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    by_time = Window.partitionBy(*keys).orderBy("_bucket")
    counts = (
        counts.withColumn("_b", F.sum("_n").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("n_total", F.sum("_n").over(Window.partitionBy(*keys)))
        .withColumn("_a", F.col("_b") - F.col("_n"))
        .withColumn("_core", F.floor(F.col("_a") / F.lit(size)).cast("long"))
    )
    if size >= 4 * halo:
        # A chunk that holds fewer rows than the halo has small buckets, so the one behind it is nearly full: two on either
        # side are enough. A bucket goes to those that end, or start, within the halo of it.
        spans = counts.groupBy(*keys, "_core").agg(F.min("_a").alias("_s"), F.max("_b").alias("_e"))
        by_core = Window.partitionBy(*keys).orderBy("_core")
        near = [F.lag(F.struct("_core", "_e"), k).over(by_core).alias(f"_p{k}") for k in (1, 2)] + [F.lead(F.struct("_core", "_s"), k).over(by_core).alias(f"_q{k}") for k in (1, 2)]
        spans = spans.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.col("_core").alias("_c"), *near)
        same = F.col("_core") == F.col("_c")
        for k in keys:
            same &= F.col(k).eqNullSafe(F.col(f"_s_{k}"))
        counts = counts.join(spans, same)
        others = [F.when(F.col("_a") - F.col(f"_p{k}._e") < halo, F.col(f"_p{k}._core")) for k in (1, 2)] + [F.when(F.col(f"_q{k}._s") - F.col("_b") < halo, F.col(f"_q{k}._core")) for k in (1, 2)]
        needed = F.array_compact(F.array("_core", *others))
    else:
        counts = counts.withColumns({
            "_before": F.collect_list(F.struct("_core", "_a", "_b")).over(by_time.rowsBetween(-halo, -1)),
            "_after": F.collect_list(F.struct("_core", "_a", "_b")).over(by_time.rowsBetween(1, halo)),
        })
        # rows of this bucket are needed by a chunk that ends at most halo rows before it or starts at most halo rows behind it
        back = F.transform(F.filter("_before", lambda p: p["_b"] > F.col("_a") - halo), lambda p: p["_core"])
        ahead = F.transform(F.filter("_after", lambda p: p["_a"] < F.col("_b") + halo), lambda p: p["_core"])
        needed = F.array_distinct(F.concat(F.array("_core"), back, ahead))
    plan = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_bucket").alias("_kb"), "_core", "n_total", F.explode(needed).alias("chunk"))
    on = F.col("_bucket") == F.col("_kb")
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(plan, on).withColumn("core", F.col("chunk") == F.col("_core")).drop("_bucket", "_kb", "_core", *[f"_k_{k}" for k in keys])
