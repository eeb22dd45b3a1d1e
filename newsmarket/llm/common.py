"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmarket.functions.bloom import bloom_bits, maybe_in  # noqa: F401


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder that the driver and all executors can reach.

    It lies under ``spark.checkpoint.dir``; where that is unset (tests on one machine), under the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir") + "/_shared"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str, codec: str = "snappy", **options: str) -> DataFrame:
    """Write a table and read it back: lineage ends here, and a lost executor costs no rerun. options are the writer's."""
    df.write.mode("overwrite").options(compression=codec, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000, mb: int = 16) -> None:
    """Bound the rows of an Arrow batch and its bytes, since texts can be long; a batch holds one row at least."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def unsigned_mod(col: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(n))
