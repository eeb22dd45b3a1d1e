"""Landed feeds, nested series, statements, dictionaries and pages as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsmarket.functions.html import rows_under

FEED = "title string, link string, guid string, description string, pubDate string"


def read_feed(spark: SparkSession, path: str, schema: str = FEED) -> DataFrame:
    """Items of landed feed files."""
    return spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)


def union_feeds(feeds: list[DataFrame], order: list[str]) -> DataFrame:
    """Union of query feeds without repeats of id, else link: the first in ``order`` wins; entries with neither all stay."""
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    key = F.coalesce(F.nullif(F.trim("id"), F.lit("")), F.nullif(F.trim("link"), F.lit("")))
    out = out.withColumn("_key", key)
    first = out.where("_key is not null").withColumn("_rn", F.row_number().over(Window.partitionBy("_key").orderBy(*order))).where("_rn = 1").drop("_rn")
    return first.unionByName(out.where("_key is null")).drop("_key")


BANK = "struct<bmx:struct<series:array<struct<idSerie:string,titulo:string,datos:array<struct<fecha:string,dato:string>>>>>>"
STATISTICS = "struct<Series:array<struct<INDICADOR:string,OBSERVATIONS:array<struct<TIME_PERIOD:string,OBS_VALUE:string>>>>>"


def bank_series(df: DataFrame, col: str) -> DataFrame:
    """series_id, fecha, dato of central-bank JSON documents, values untouched."""
    s = df.select(F.explode(F.from_json(col, BANK)["bmx"]["series"]).alias("s"))
    return s.select(F.col("s.idSerie").alias("series_id"), F.explode("s.datos").alias("d")).select("series_id", "d.fecha", "d.dato")


def statistics_series(df: DataFrame, col: str) -> DataFrame:
    """indicador_id, periodo, valor of statistics JSON documents; a series without observations keeps one row."""
    s = df.select(F.explode(F.from_json(col, STATISTICS)["Series"]).alias("s"))
    return s.select(F.col("s.INDICADOR").alias("indicador_id"), F.explode_outer("s.OBSERVATIONS").alias("d")).select("indicador_id", F.col("d.TIME_PERIOD").alias("periodo"), F.col("d.OBS_VALUE").alias("valor"))


def price_rows(df: DataFrame) -> DataFrame:
    """OHLCV rows: NaN becomes null, a null volume 0; adj_close is close only where the column is absent."""
    num = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    adj = num("adj_close") if "adj_close" in df.columns else num("close").alias("adj_close")
    return df.select("ticker", "date", *[num(c) for c in ("open", "high", "low", "close")], adj, F.coalesce(F.col("volume").cast("long"), F.lit(0).cast("long")).alias("volume"))


def pivot_statements(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """One row for each (ticker, period_end): of a field the first statement (by ``priority``) that has it wins.

    rows: ticker, period_end, field, priority, value; fields maps source names to ours. Rows without any value go.
    """
    named = rows.where(F.col("field").isin(list(fields))).replace(fields, subset=["field"])
    value = lambda name: F.min_by("value", F.when((F.col("field") == name) & F.col("value").isNotNull(), F.col("priority"))).alias(name)
    names = list(dict.fromkeys(fields.values()))
    return named.groupBy("ticker", "period_end").agg(*[value(n) for n in names]).where(F.coalesce(*names).isNotNull())


def read_dictionary(spark: SparkSession, path: str, source: str) -> DataFrame:
    schema = "legal_name string, commercial_name string, ticker string, sector string, country string"
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("source", F.lit(source))


def table_rows(pages: DataFrame, html: str, header: str) -> DataFrame:
    """Rows of the first table that has a header cell named ``header``, as a map by header name, with the row's link.

    Quoted values, tables within cells and ends of rows and cells that are left out are understood; a
    page without such a table, or null, gives no rows.
    """
    rows = F.udf(lambda page: rows_under(page, header), "array<struct<cells:map<string,string>,link:string>>", useArrow=True)
    return pages.withColumn("_r", F.explode(rows(F.col(html)))).select(*pages.columns, "_r.cells", "_r.link")


def latest_report(links: DataFrame) -> DataFrame:
    """issuer, url of the latest report: by year and quarter in the link, else by its number; annexes do not count."""
    u = F.lower("url")
    year, quarter = F.regexp_extract(u, r"(?<!\d)((?:19|20)\d{2})(?!\d)", 1), F.regexp_extract(u, r"(?:([1-4])[qt](?:\d|\b|_)|[qt]([1-4]))", 1)
    other = F.regexp_extract(u, r"(?:([1-4])[qt](?:\d|\b|_)|[qt]([1-4]))", 2)
    number = F.regexp_extract(u, r"(\d+)(?!.*\d)", 1)
    rank = F.struct(F.coalesce(year.try_cast("int"), F.lit(0)).alias("y"), F.coalesce(quarter.try_cast("int"), other.try_cast("int"), F.lit(0)).alias("q"), F.coalesce(number.try_cast("bigint"), F.lit(0)).alias("n"), F.col("url"))
    return links.where(~u.rlike("anexo|annex")).groupBy("issuer").agg(F.max_by("url", rank).alias("url"))
