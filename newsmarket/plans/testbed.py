"""Adapters: the given tables as prices, series, statements, sessions, news and vectors.

Each adapter is one SQL text that both Spark and the oracle engine read; ``{table}`` stands for a
given table.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from newsmarket.functions.text import BLANKS

BENCHMARK = "ALL"
HOLIDAYS = ("1994-01-03", "1995-05-01", "1996-09-16", "1997-12-25", "1998-01-01")

ADAPTERS = {
    "px": """
SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date, min_by(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
  min(o_totalprice) AS low, max(o_totalprice) AS close, max(o_totalprice) AS adj_close, count(*) AS volume
FROM {orders} GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)
UNION ALL
SELECT 'ALL', CAST(o_orderdate AS DATE), min_by(o_totalprice, o_orderkey), max(o_totalprice), min(o_totalprice), max(o_totalprice), max(o_totalprice), count(*)
FROM {orders} WHERE NOT (CAST(o_orderdate AS DATE) >= DATE '1998-06-01' AND CAST(o_orderdate AS DATE) < DATE '1998-07-01') GROUP BY CAST(o_orderdate AS DATE)""",
    "macro": """
SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS value FROM {orders} GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)""",
    "fund": """
SELECT c_mktsegment AS ticker, last_day(CAST(date_trunc('quarter', o_orderdate) AS DATE) + 62) AS period_end,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS ingresos_totales, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS utilidad_neta
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey GROUP BY 1, 2""",
    "sessions": """
SELECT session_date, CAST(row_number() OVER (ORDER BY session_date) AS INT) AS session_no FROM (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS session_date FROM {orders}) s
WHERE CAST(extract(dow FROM session_date) AS INT) NOT IN ({weekend}) AND CAST(session_date AS STRING) NOT IN ("""
    + ", ".join(f"'{d}'" for d in HOLIDAYS)
    + ")",
    "news_raw": """
SELECT doc_id, CASE WHEN doc_id % 50 = 7 THEN 'other_feed' ELSE source END AS source, {title} AS title, text AS content,
  CASE WHEN doc_id % 40 = 3 THEN '  ' WHEN doc_id % 40 = 4 THEN 'ftp:/broken' ELSE concat('https://', source, '.example.org/', CAST(doc_id AS STRING)) END AS url,
  CASE WHEN doc_id % 60 = 11 THEN 'yesterday' WHEN doc_id % 60 = 12 THEN '31/07/2026'
    ELSE concat(CAST(DATE '1995-01-01' + CAST(floor((doc_id * 37 % 57000) / 24.0) AS INT) AS STRING), 'T', lpad(CAST((doc_id * 37 % 57000) % 24 AS STRING), 2, '0'), ':00:00') END AS published_at
FROM {documents}""",
    "news": """
SELECT doc_id, CAST(doc_id AS STRING) AS guid, source, {title} AS title, text AS content,
  CAST(DATE '1995-01-01' + CAST(floor((doc_id * 37 % 57000) / 24.0) AS INT) AS TIMESTAMP) + make_interval({hours}) AS published_at,
  CASE WHEN doc_id % 3 = 0 THEN 'negative' WHEN doc_id % 3 = 1 THEN 'positive' ELSE 'neutral' END AS sentiment,
  CASE WHEN doc_id % 5 = 0 THEN '1-URGENT' WHEN doc_id % 5 = 1 THEN '2-HIGH' WHEN doc_id % 5 = 2 THEN 'ALL' END AS model_ticker,
  CASE WHEN doc_id % 7 = 0 THEN '2-HIGH' WHEN doc_id % 7 = 1 THEN '9-NONE' END AS lexicon_ticker,
  CASE WHEN doc_id % 4 = 0 THEN 'banks' WHEN doc_id % 4 = 1 THEN 'retail' WHEN doc_id % 4 = 2 THEN 'other' END AS sector,
  CASE WHEN doc_id % 6 = 0 THEN 'Kueski' WHEN doc_id % 6 = 1 THEN 'Nobody' END AS fintech
FROM {documents}""",
}
# Words of the two engines for the same thing.
_SPARK = {"weekend": "1, 7", "title": "substring_index(text, '.', 1)", "hours": "0, 0, 0, 0, CAST((doc_id * 37 % 57000) % 24 AS INT)"}
_ORACLE = {"weekend": "0, 6", "title": "split_part(text, '.', 1)", "hours": "hours := CAST((doc_id * 37 % 57000) % 24 AS INT)"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that all executors see, under the cluster's checkpoint folder or, on one machine only, the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir") + "/_shared"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def adapter(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = ADAPTERS[name]
    for k, v in _SPARK.items():
        text = text.replace("{" + k + "}", v)
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", text))})


def oracle(body: str, *names: str) -> str:
    """The body with the named adapters as common table expressions."""
    parts = []
    for name in names:
        text = ADAPTERS[name]
        for k, v in _ORACLE.items():
            text = text.replace("{" + k + "}", v)
        text = text.replace("make_interval(hours := ", "to_hours(")
        parts.append(f"{name} AS ({re.sub(r'[{](\w+)[}]', r'\1', text)})")
    head = ", ".join(parts)
    if not names:
        return stripping(body)
    return stripping(f"WITH {head}, {body.lstrip()[5:]}" if body.lstrip().upper().startswith("WITH ") else f"WITH {head} {body}")


def stripping(sql: str) -> str:
    """The oracle's text with each ``trim(x)`` made to strip white space of any kind."""
    return re.sub(r"\btrim\(((?:[^()]|\((?:[^()]|\([^()]*\))*\))*)\)", lambda m: f"trim({m[1]}, '{BLANKS}')", sql)
