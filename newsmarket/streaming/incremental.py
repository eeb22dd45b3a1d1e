"""Incremental validation of landed files, with what is known of each key as state of the stream.

Rows are checked as they arrive. For each guid the stream keeps its first arrival, its last valid
values, and how often, since when and why last it was rejected. A batch gives the present state of
the guids it touched, in absolute values, and these are upserted into two tables that are
partitioned by the month of publication, so only the months touched are rewritten. A batch that runs again
after a failure starts from the state before it and writes the same values, so nothing is counted
twice. The state is that of streaming aggregates; only with timers that forget is it a processor's. Rejects without a guid are appended, a folder a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from newsmarket.functions.text import utc_text
from newsmarket.operators import partitioned

_STATE = "arrived long, payload string, rejected_at long, first_rejected_at long, times long, reason string, detail string, rejected string"
_KNOWN = f"guid string, source string, published_ts timestamp, {_STATE}"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Known(StatefulProcessor):
    """State of a guid; once the stream is ``forget_ms`` past its last arrival a timer drops it, if given (its counts then start anew)."""

    def __init__(self, forget_ms: int | None = None) -> None:
        self.forget_ms = forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", _STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        arrived, payload, last, first, times, reason, detail, rejected = self.known.get() or (None, None, None, None, 0, None, None, None)
        source = at = None
        for row in sorted((r for pdf in rows for r in pdf.itertuples(index=False)), key=lambda r: (r.arrived, r.row)):
            source, at = row.source, row.published_ts
            if row.reason is None:
                arrived, payload = row.arrived if arrived is None else arrived, row.row
            else:
                first, last, times = row.arrived if first is None else first, row.arrived, times + 1
                reason, detail, rejected = row.reason, row.detail, row.row
        state = tuple(None if x is None else int(x) if k in (0, 2, 3, 4) else x for k, x in enumerate((arrived, payload, last, first, times, reason, detail, rejected)))
        self.known.update(state)
        if self.forget_ms is not None:
            for due in list(self.handle.listTimers()):
                self.handle.deleteTimer(due[0] if isinstance(due, tuple) else due)
            self.handle.registerTimer(row.arrived // 1000 + self.forget_ms)
        out = pd.DataFrame([(key[0], source, at, *state)], columns=[c.split()[0] for c in _KNOWN.split(", ")])
        yield out.astype({c: "Int64" for c in ("arrived", "rejected_at", "first_rejected_at", "times")})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.known.clear()
        yield from ()

    def close(self) -> None:
        pass


def _known(rows: DataFrame) -> DataFrame:
    """The same state as aggregates, which the stream keeps without Python: all but the timer's forgetting."""
    good, at = F.col("reason").isNull(), F.struct("arrived", "row")
    last = F.max(F.struct("arrived", "row", "source", "published_ts"))
    bad = F.max(F.when(~good, F.struct("arrived", "row", "reason", "detail")))
    first = F.min(F.when(~good, F.col("arrived")))
    got = rows.groupBy("guid").agg(last.alias("last"), F.min(F.when(good, F.col("arrived"))).alias("arrived"), F.max(F.when(good, at)).alias("good"), bad.alias("bad"), first.alias("first_rejected_at"), F.count_if(~good).alias("times"))
    return got.select("guid", "last.source", "last.published_ts", "arrived", F.col("good.row").alias("payload"), F.col("bad.arrived").alias("rejected_at"), "first_rejected_at", "times", "bad.reason", "bad.detail", F.col("bad.row").alias("rejected"))


def _table_columns(schema: StructType) -> tuple[list[str], list[str]]:
    return [f.name for f in schema if f.name != "source"], ["first_arrived_at"]


def run(spark: SparkSession, landed: str, schema: str, check: Callable[[DataFrame], DataFrame], valid: str, quarantine: str, checkpoint: str, forget_ms: int | None = None) -> None:
    """Check the rows of files that are new since the last run and bring both tables up to date.

    ``check`` is a contract: it adds guid, published_ts, rejection_reason and rejection_detail. Valid
    rows are kept as the contract leaves them, rejects as they came. Every arrival counts, an
    unchanged one too; of several rows of a guid in a batch the last by their text stands. Rows with a null guid go to ``<quarantine>_loose``.
    """
    rows = spark.readStream.schema(schema).json(landed)
    row_type = StructType.fromDDL(schema)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stamped = rows.withColumn("arrived_at", F.current_timestamp())
    if forget_ms is not None:  # the time of the timers is that of arrival, so no row is late
        stamped = stamped.withWatermark("arrived_at", "0 seconds")
    checked = check(stamped.withColumn("row", F.to_json(F.struct(*rows.columns))))
    flat = checked.select("guid", "source", "published_ts", F.unix_micros("arrived_at").alias("arrived"), F.when(F.col("rejection_reason").isNull(), F.to_json(F.struct(*rows.columns))).otherwise(F.col("row")).alias("row"), F.col("rejection_reason").alias("reason"), F.col("rejection_detail").alias("detail"), "arrived_at")
    keyed = flat.where("guid is not null")
    if forget_ms is None:
        keyed = _known(keyed)
    else:
        keyed = keyed.groupBy("guid").transformWithStateInPandas(Known(forget_ms), _KNOWN, "Update", "EventTime")
    none = lambda kind: F.lit(None).cast(kind)
    loose = flat.where("guid is null").select("guid", "source", "published_ts", none("long").alias("arrived"), none("string").alias("payload"), F.col("arrived").alias("rejected_at"), F.col("arrived").alias("first_rejected_at"), F.lit(1).cast("long").alias("times"), "reason", "detail", F.col("row").alias("rejected"))
    columns, keep = _table_columns(row_type)

    def load(batch: DataFrame, number: int) -> None:
        work = f"{checkpoint}_work"
        path = f"{work}/batch={number}"
        batch.write.mode("overwrite").parquet(path)  # computed once, for all three tables
        now = spark.read.schema(batch.schema).parquet(path)
        month = F.left(utc_text(F.col("published_ts")), F.lit(7))
        parsed = now.where("guid is not null and payload is not null").withColumn("v", F.from_json("payload", row_type))
        good = parsed.select("guid", "source", "published_ts", *[F.col(f"v.{c}").alias(c) for c in columns], F.timestamp_micros("arrived").alias("first_arrived_at"))
        partitioned.upsert_into(valid, good, ["guid", "published_ts"], ["source", *columns], keep, ["guid"], month, work)
        bad = now.where("times > 0").select("guid", "source", "published_ts", "reason", "detail", F.col("rejected").alias("payload"), F.col("times").alias("times_rejected"), F.timestamp_micros("first_rejected_at").alias("first_rejected_at"), F.timestamp_micros("rejected_at").alias("rejected_at"))
        bad = bad.withColumn("batch", F.lit(str(number)))
        values = ["reason", "detail", "payload", "batch", "times_rejected", "first_rejected_at", "rejected_at"]
        partitioned.upsert_into(quarantine, bad.where("guid is not null"), ["source", "guid", "published_ts"], values, [], ["guid"], month, work)
        bad.where("guid is null").drop("published_ts").write.mode("overwrite").parquet(f"{quarantine}_loose/epoch={number}")

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        keyed.unionByName(loose).writeStream.foreachBatch(load).outputMode("Update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def current(spark: SparkSession, valid: str, schema: str) -> DataFrame:
    """The table of valid rows: one row a guid, as it stands."""
    columns, keep = _table_columns(StructType.fromDDL(schema))
    types = {f.name: f.dataType for f in StructType.fromDDL(schema)}
    full = StructType().add("guid", "string").add("published_ts", "timestamp").add("source", "string")
    for c in columns:
        full = full.add(c, types[c])
    return partitioned.read_table(spark, valid, full.add(keep[0], "timestamp")).drop("part")


def current_quarantine(spark: SparkSession, quarantine: str) -> DataFrame:
    """Rejects: one row a (source, guid) with the latest reason, detail, payload and batch, how often and since when; without a guid every arrival."""
    tail = "reason string, detail string, payload string, batch string, times_rejected long, first_rejected_at timestamp, rejected_at timestamp"
    keyed = partitioned.read_table(spark, quarantine, StructType.fromDDL(f"source string, guid string, published_ts timestamp, {tail}")).drop("part", "published_ts")
    loose = f"{quarantine}_loose"
    if not partitioned.exists(spark, loose):
        return keyed
    return keyed.unionByName(spark.read.schema(f"source string, guid string, {tail}").parquet(loose).select(keyed.columns))
