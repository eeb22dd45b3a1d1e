"""As-of joins as one sort and window over the key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lagged_by_year(series: DataFrame, keys: list[str], date: str, values: list[str]) -> DataFrame:
    """Adds <value>_year_ago of the latest row of the key dated a year or more before (29 February counts from 28)."""
    # A year back is not monotone in days, so both sides share one axis: a row as target sits at its date less a year.
    rows = series.select(*keys, F.col(date).alias("_t"), F.lit(0).alias("_side"), F.struct(*values).alias("_v"), F.lit(None).cast(series.schema).alias("_row"))
    asks = series.select(*keys, F.add_months(date, -12).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(rows.schema["_v"].dataType).alias("_v"), F.struct(*[F.col(c) for c in series.columns]).alias("_row"))
    order = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.unionByName(asks).withColumn("_found", F.last("_v", ignorenulls=True).over(order)).where("_side = 1")
    return found.select(*[F.col(f"_row.{c}").alias(c) for c in series.columns], *[F.col(f"_found.{v}").alias(f"{v}_year_ago") for v in values])


def forward(targets: DataFrame, prices: DataFrame, key: str, at: str, date: str, columns: list[str]) -> DataFrame:
    """Adds to each target the first row of its key dated ``at`` or later: its date and ``columns``, else nulls.

    Only distinct (key, date) pairs enter the window, so its size is bounded by the calendar even
    if one key holds most targets; the targets then join on both columns.
    """
    kind = prices.select(F.struct(date, *columns).alias("s")).schema["s"].dataType
    asked = targets.select(F.col(key).alias("_k"), F.col(at).alias("_t")).where("_t is not null").distinct()
    left = asked.select("_k", "_t", F.lit(0).alias("_side"), F.lit(None).cast(kind).alias("_v"))
    right = prices.select(F.col(key).alias("_k"), F.col(date).alias("_t"), F.lit(1).alias("_side"), F.struct(date, *columns).alias("_v"))
    order = Window.partitionBy("_k").orderBy("_t", "_side").rowsBetween(0, Window.unboundedFollowing)
    found = left.unionByName(right).withColumn("_v", F.first("_v", ignorenulls=True).over(order)).where("_side = 0")
    found = found.select(F.col("_k").alias(key), F.col("_t").alias(at), *[F.col(f"_v.{c}").alias(c) for c in (date, *columns)])
    return targets.join(found, [key, at], "left").select(*targets.columns, date, *columns)


def snapshot(dates: DataFrame, series: DataFrame, wanted: list[str]) -> DataFrame:
    """Each date of ``dates`` (column date) with a map series -> (date, value) of the latest values up to it.

    The map is null where no wanted series has a value yet. Wanted series are a short list, so
    dates are repeated for them before the as-of window, which is partitioned by series.
    """
    known = series.where(F.col("series_id").isin(wanted)).select("series_id", F.col("date").alias("_t"), F.lit(0).alias("_side"), F.struct("date", "value").alias("_v"))
    asks = dates.select("date").distinct().select(F.explode(F.array(*map(F.lit, wanted))).alias("series_id"), F.col("date").alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(known.schema["_v"].dataType).alias("_v"))
    order = Window.partitionBy("series_id").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = known.unionByName(asks).withColumn("_found", F.last("_v", ignorenulls=True).over(order)).where("_side = 1")
    entry = F.when(F.col("_found").isNotNull(), F.struct(F.col("series_id").alias("key"), F.col("_found").alias("value")))
    maps = found.groupBy(F.col("_t").alias("date")).agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    return maps.select("date", F.when(F.size("_e") > 0, F.map_from_entries("_e")).alias("macro_context"))
