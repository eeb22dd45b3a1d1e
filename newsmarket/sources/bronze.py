"""Raw batches: immutable folders category=/source=/date=/batch= of JSON, with a metadata row and digests of their content."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Number of a record in its batch.
NUMBER = "record_no"


def flat(df: DataFrame) -> DataFrame:
    """Scalars as they are, nested columns as JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema])


#: Records in a block of a batch, and digests in a node of the tree above the blocks.
BLOCK, FAN = 1000, 1000


def canonical(x: Column | str, kind: T.DataType) -> Column:
    """A value with the fields of every struct in the order of their names and maps as sorted entries, so that JSON of it depends on content alone."""
    x = F.col(x) if isinstance(x, str) else x
    if isinstance(kind, T.StructType):
        fields = [canonical(x[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(x.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(x, lambda e: canonical(e, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform(F.array_sort(F.map_entries(x)), lambda e: F.struct(e["key"].alias("key"), canonical(e["value"], kind.valueType).alias("value")))
    return x


def record_json(schema: T.StructType) -> Column:
    """A record as canonical JSON: names in order, nulls left out."""
    return F.to_json(F.struct(*[canonical(f.name, f.dataType).alias(f.name) for f in sorted(schema.fields, key=lambda f: f.name) if f.name != NUMBER]))


def blocks(payload: DataFrame, schema: T.StructType) -> DataFrame:
    """block, n_records, sha256: of each BLOCK records in the order of their numbers the digest of the records' digests."""
    records = payload.select(F.floor(F.col(NUMBER) / BLOCK).cast("long").alias("block"), F.col(NUMBER).alias("at"), F.sha2(record_json(schema), 256).alias("digest"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda r: r["digest"])
    return records.groupBy("block").agg(F.count("*").alias("n_records"), F.sha2(F.array_join(ordered, ""), 256).alias("sha256"))


def root_digest(found: DataFrame) -> tuple[int, str]:
    """Number of records and digest of a batch, by a tree over its blocks: no node has more than FAN children."""
    level = found.select(F.col("block").alias("k"), "n_records", "sha256")
    while True:
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("k", "sha256"))), lambda r: r["sha256"])
        level = level.groupBy(F.floor(F.col("k") / FAN).alias("k")).agg(F.sum("n_records").alias("n_records"), F.sha2(F.array_join(ordered, ""), 256).alias("sha256"))
        few = level.limit(2).collect()
        if len(few) < 2:
            return (few[0]["n_records"], few[0]["sha256"]) if few else (0, "")


def write_batch(df: DataFrame, root: str, category: str, source: str, date: str, batch: str | None = None) -> str:
    """Append one batch under a new path; an existing batch is an error. Returns the path of the batch.

    The input is evaluated once, into the payload: a line of JSON a record with its number. Columns and
    metadata come from the payload: ingest time, record count, the digest of the whole and of each
    block. Digests are of canonical JSON, so the order of keys and of files does not matter.
    """
    spark = df.sparkSession
    path = f"{root}/category={category}/source={source}/date={date}/batch={batch or uuid.uuid4().hex}"
    df.withColumn(NUMBER, F.monotonically_increasing_id()).write.mode("errorifexists").json(f"{path}/payload")
    payload = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(NUMBER, T.LongType())])).json(f"{path}/payload")
    flat(payload.drop(NUMBER)).write.mode("errorifexists").parquet(f"{path}/columns")
    blocks(payload, df.schema).write.mode("errorifexists").parquet(f"{path}/blocks")
    n, digest = root_digest(spark.read.parquet(f"{path}/blocks"))
    meta = spark.createDataFrame([(n, digest)], "n_records long, sha256 string").withColumn("ingested_at", F.current_timestamp())
    meta.coalesce(1).write.mode("errorifexists").parquet(f"{path}/metadata")
    return path


_PARTS = "category string, source string, date string, batch string"


def read_batches(spark: SparkSession, root: str, schema: str, category: str = "*", source: str = "*", date: str = "*") -> DataFrame:
    """Payload rows with category, source, date and batch as partition columns.

    The arguments pick folders before anything is listed; later filters on these columns, and joins on
    them with small tables, prune folders too. A record's number is not among the columns.
    """
    glob = f"{root}/category={category}/source={source}/date={date}/batch=*/payload"
    return spark.read.option("basePath", root).schema(f"{schema}, {_PARTS}").json(glob)


def stored_inventory(spark: SparkSession, root: str) -> DataFrame:
    """source, n_batches, n_records, last_date of what is stored, from the metadata alone; no payload is read."""
    meta = spark.read.option("basePath", root).schema(f"n_records long, sha256 string, ingested_at timestamp, {_PARTS}").parquet(f"{root}/category=*/source=*/date=*/batch=*/metadata")
    return meta.groupBy("source").agg(F.count_distinct("batch").alias("n_batches"), F.sum("n_records").alias("n_records"), F.max("date").alias("last_date"))


def damaged(spark: SparkSession, root: str, schema: str, category: str = "*", source: str = "*", date: str = "*") -> DataFrame:
    """batch, block: blocks whose records are no longer those written, or that are missing or new; an edited record is named by its block."""
    at = f"{root}/category={category}/source={source}/date={date}/batch=*"
    kind = T.StructType.fromDDL(schema)
    # By the path and not as a partition column: records may have columns of those names.
    batch = F.regexp_extract(F.input_file_name(), r"/batch=([^/]+)/", 1).alias("batch")
    payload = spark.read.schema(T.StructType([*kind.fields, T.StructField(NUMBER, T.LongType())])).json(f"{at}/payload").select("*", batch)
    records = payload.select("batch", F.floor(F.col(NUMBER) / BLOCK).cast("long").alias("block"), F.col(NUMBER).alias("at"), F.sha2(record_json(kind), 256).alias("digest"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda r: r["digest"])
    now = records.groupBy("batch", "block").agg(F.sha2(F.array_join(ordered, ""), 256).alias("now"))
    kept = spark.read.option("basePath", root).schema("block long, n_records long, sha256 string, batch string").parquet(f"{at}/blocks").select("batch", "block", "sha256")
    return kept.join(now, ["batch", "block"], "full_outer").where(~F.col("now").eqNullSafe(F.col("sha256"))).select("batch", "block")


def inventory(rows: DataFrame) -> DataFrame:
    """Batches, records and last date of each source."""
    return rows.groupBy("source").agg(F.count_distinct("batch").alias("n_batches"), F.count("*").alias("n_records"), F.max("date").alias("last_date"))


def missing_sources(rows: DataFrame, expected: list[str]) -> DataFrame:
    """Expected sources that have no batch."""
    want = rows.sparkSession.createDataFrame([(s,) for s in expected], "source string")
    return want.join(rows.select("source").distinct(), "source", "left_anti")
