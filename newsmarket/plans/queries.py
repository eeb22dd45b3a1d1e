"""The registered queries of the library and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import market, state, text

QUERIES = {**market.QUERIES, **text.QUERIES, **state.QUERIES}
ORACLE_SQL = {**market.SQL, **text.SQL, **state.SQL}


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: negative news followed by a fall."""
    return QUERIES["negative_then_fall"](spark, sf_dir)
