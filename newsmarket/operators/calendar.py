"""Trading sessions: a table (session_date, session_no)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmarket.functions.columns import free

from .asof import forward


def number_sessions(days: DataFrame) -> DataFrame:
    """Number distinct session dates; a calendar has some thousands of rows."""
    from pyspark.sql import Window

    return days.select("session_date").distinct().withColumn("session_no", F.row_number().over(Window.orderBy("session_date")))


def next_session(df: DataFrame, date: str, sessions: DataFrame) -> DataFrame:
    """Adds next_session: the first session strictly after ``date``, and days_to_session."""
    after = free("after_", df)
    keyed = df.withColumn(after, F.date_add(date, 1))
    # The dates asked for are few, whatever the rows: look each up once, then join back.
    asked = keyed.select(F.lit(1).alias("all_"), F.col(after).alias("after_")).where("after_ is not null").distinct()
    found = forward(asked, sessions.select(F.lit(1).alias("all_"), "session_date"), "all_", "after_", "session_date", [])
    out = keyed.join(found.select(F.col("after_").alias(after), F.col("session_date").alias("next_session")), after, "left").drop(after)
    return out.withColumn("days_to_session", F.datediff("next_session", date))


def shift_sessions(df: DataFrame, date: str, n: int, sessions: DataFrame, name: str) -> DataFrame:
    """Adds the session ``n`` sessions after ``date``; null if date is no session or the calendar ends."""
    no = free("no_", df)
    at = sessions.select(F.col("session_date").alias(date), F.col("session_no").alias(no))
    to = sessions.select(F.col("session_date").alias(name), (F.col("session_no") - n).alias(no))
    return df.join(at, date, "left").join(to, no, "left").drop(no)


def sessions_between(sessions: DataFrame, first: str, last: str) -> DataFrame:
    return sessions.where(F.col("session_date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))


def closed_bars(bars: DataFrame, ts: str, zone: str = "America/Mexico_City", close_hour: int = 15) -> DataFrame:
    """Rows stamped on a weekend or at or after the close in local time: complete bars."""
    local = F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone)
    return bars.where(F.dayofweek(local).isin(1, 7) | (F.hour(local) >= close_hour))


def on_local_date(df: DataFrame, ts: str, first: str, last: str, zone: str = "America/Mexico_City") -> DataFrame:
    """Adds local_date of a UTC instant and keeps a range of it."""
    local = F.to_date(F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone))
    return df.withColumn("local_date", local).where(F.col("local_date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))


def on_weekend_edge(df: DataFrame, date: str) -> DataFrame:
    """Rows dated Friday, Saturday or Sunday."""
    return df.where(F.dayofweek(date).isin(6, 7, 1))
