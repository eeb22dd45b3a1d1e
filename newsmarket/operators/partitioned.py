"""Upserts into a folder of Parquet that rewrite only the partitions that a batch touches.

The target is partitioned by a column that follows from the key (the month of a date, a bucket of a
hash), so a key never moves. A batch is collapsed and staged once; the partitions it has are read
back by partition pruning, joined and overwritten in place (dynamic overwrite), and all others stay
as they are, unread. New and updated rows are counted on the way by an ``Observation``, in the job
that writes. A batch that is run again, after a failure in the middle too, leaves the same rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsmarket.operators.upsert import collapse

#: So many touched partitions are named in the read; a batch that touches more reads the whole target.
NAMED = 10_000


@dataclass(frozen=True)
class Counts:
    """What a batch did: keys that the target lacked, keys that it had, rows of the partitions written, and these partitions."""

    n_new: int
    n_updated: int
    n_rows: int
    partitions: tuple[str, ...]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there and holds anything, in whatever store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(at)) and len(fs.listStatus(at)) > 0


def read_table(spark: SparkSession, path: str, schema: StructType, part: str = "part") -> DataFrame:
    """The target with its partition column as text; empty if nothing was written yet."""
    full = StructType.fromJson(json.loads(schema.json())).add(part, "string")
    return spark.read.schema(full).parquet(path) if exists(spark, path) else spark.createDataFrame([], full)


def upsert_into(path: str, updates: DataFrame, keys: list[str], overwrite: list[str], keep: list[str], order: list[str], by: Column, work: str, part: str = "part") -> Counts:
    """Upsert a batch into the folder ``path``; ``work`` is a folder for the staged batch that all executors share.

    Of several updates of a key the last in ``order`` wins; ``overwrite`` columns take the update's
    values and ``keep`` columns stay as first seen. ``by`` gives the partition from the keys alone; a
    null is a partition of its own. An empty batch writes nothing.
    """
    spark = updates.sparkSession
    staged_path = f"{work}/{uuid.uuid4().hex}"
    staged = collapse(updates, keys, order, overwrite, keep).withColumn(part, F.coalesce(by.cast("string"), F.lit("none")))
    staged.write.parquet(staged_path)
    staged = spark.read.schema(staged.schema).parquet(staged_path)
    touched = [r[0] for r in staged.select(part).distinct().limit(NAMED + 1).collect()]
    if not touched:
        return Counts(0, 0, 0, ())
    columns = [*keys, *overwrite, *keep]
    old = read_table(spark, path, staged.select(columns).schema, part)
    if len(touched) <= NAMED:
        old = old.where(F.col(part).isin(touched))
    else:
        old = old.join(staged.select(part).distinct(), part, "left_semi")
    both = old.withColumn("_t", F.lit(True)).alias("t").join(staged.withColumn("_u", F.lit(True)).alias("u"), [*keys, part], "full_outer")
    hit, known = F.col("u._u").isNotNull(), F.col("t._t").isNotNull()
    values = [F.when(hit, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in overwrite]
    values += [F.when(known, F.col(f"t.{c}")).otherwise(F.col(f"u.{c}")).alias(c) for c in keep]
    seen = Observation()
    rows = both.select(*keys, *values, part, (~known).alias("_new"), (hit & known).alias("_old"))
    rows = rows.observe(seen, F.count_if("_new").alias("n_new"), F.count_if("_old").alias("n_updated"), F.count("*").alias("n_rows"))
    rows = rows.drop("_new", "_old").hint("rebalance", part)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    found = seen.get
    return Counts(found["n_new"], found["n_updated"], found["n_rows"], tuple(sorted(touched)))
