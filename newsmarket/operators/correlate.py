"""News against the market: targets, next session, price, change and macro context in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .asof import forward, snapshot
from .calendar import next_session, shift_sessions
from .dictionary import first_known


def targets(news: DataFrame, universe: list[str], proxies: DataFrame, fintechs: DataFrame) -> DataFrame:
    """guid, ticker, relation, label: direct tickers and, for the sector, proxies that are not direct.

    news: guid, model_tickers, lexicon_tickers, fintechs, lexicon_fintechs (arrays), sector,
    lexicon_sector. proxies: sector, proxy, pos - a short list. The label of a proxy is the first fintech
    found by the model, else by the lexicon, of those in the dictionary table ``fintechs`` (name).
    """
    empty = F.array().cast("array<string>")
    lst = lambda c: F.coalesce(F.col(c), empty)
    known = F.array(*map(F.lit, universe))
    direct = F.array_sort(F.array_intersect(F.array_union(lst("model_tickers"), lst("lexicon_tickers")), known))
    labels = first_known(news, fintechs, "guid", ["fintechs", "lexicon_fintechs"])
    base = news.select("guid", direct.alias("direct"), F.coalesce("sector", "lexicon_sector").alias("sector"))
    by_name = base.select("guid", F.explode("direct").alias("ticker"), F.lit("direct").alias("relation"), F.lit(None).cast("string").alias("label"))
    # A news item has one sector and a sector few proxies, so the list becomes an array a sector.
    lists = proxies.groupBy("sector").agg(F.sort_array(F.collect_list(F.struct("pos", "proxy"))).alias("_p"))
    by_sector = base.join(lists, "sector").join(labels, "guid", "left").select("guid", "direct", "label", F.explode(F.transform("_p", lambda p: p["proxy"])).alias("ticker"))
    by_sector = by_sector.where(F.col("ticker").isin(universe) & ~F.array_contains("direct", F.col("ticker"))).select("guid", "ticker", F.lit("proxy").alias("relation"), "label")
    return by_name.unionByName(by_sector)


def correlate(news: DataFrame, found: DataFrame, prices: DataFrame, sessions: DataFrame, macro: DataFrame, wanted: list[str]) -> DataFrame:
    """One row for each news item, target and price: next session, that day's return, change after five
    sessions and the macro context of the news date.

    news: guid, news_date. Items without a next session or a price fall out (see ``reasons``).
    """
    dated = next_session(news, "news_date", sessions)
    asked = dated.join(found, "guid").where("next_session is not null")
    rows = forward(asked, prices.select("ticker", F.col("date").alias("price_date"), "close", F.col("daily_return_pct").alias("next_day_return_pct")), "ticker", "next_session", "price_date", ["close", "next_day_return_pct"])
    rows = shift_sessions(rows.where("price_date is not null"), "price_date", 5, sessions, "date_5")
    later = prices.select("ticker", F.col("date").alias("date_5"), F.col("close").alias("close_5"))
    rows = rows.join(later, ["ticker", "date_5"], "left").withColumn("change_5d_pct", 100 * (F.col("close_5") / F.nullif("close", F.lit(0.0)) - 1))
    context = snapshot(news.select(F.col("news_date").alias("date")), macro, wanted).withColumnRenamed("date", "news_date")
    return rows.join(context, "news_date", "left").drop("close_5", "date_5")


def curve_slope(context, short: str, long: str):
    """Basis points between two series of a macro context."""
    return F.round((F.try_element_at(context, F.lit(long))["value"] - F.try_element_at(context, F.lit(short))["value"]) * 100, 1)


def reasons(news: DataFrame, found: DataFrame, result: DataFrame, sessions: DataFrame) -> DataFrame:
    """Why items have no row: no target, outside the calendar, or no price yet; and how many."""
    dated = next_session(news, "news_date", sessions)
    has = found.select("guid").distinct().withColumn("_target", F.lit(True))
    done = result.select("guid").distinct().withColumn("_done", F.lit(True))
    why = F.when(F.col("_done").isNotNull(), "correlated").when(F.col("_target").isNull(), "no_target").when(F.col("next_session").isNull(), "outside_calendar").otherwise("no_price")
    return dated.join(has, "guid", "left").join(done, "guid", "left").groupBy(why.alias("reason")).agg(F.count("*").alias("n_news"))


def negative_then_fall(result: DataFrame, news: DataFrame, fall: float = -2.0) -> DataFrame:
    """Negative news on a ticker whose next session fell more than ``-fall`` per cent."""
    return result.join(news.where("sentiment = 'negative'").select("guid", "title"), "guid").where(F.col("next_day_return_pct") < fall)


def market_context(prices: DataFrame, result: DataFrame, macro: DataFrame, ticker: str, n: int = 20) -> DataFrame:
    """One row for a ticker: its last price row, its ``n`` most recent correlated items and each series' last value."""
    last = prices.where(F.col("ticker") == ticker).orderBy(F.desc("date")).limit(1).select("ticker", "date", "close")
    recent = result.where(F.col("ticker") == ticker).orderBy(F.desc("price_date"), "guid").limit(n).agg(F.sort_array(F.collect_list("guid")).alias("news"))
    values = macro.groupBy("series_id").agg(F.max_by("value", "date").alias("value")).agg(F.sort_array(F.collect_list(F.struct("series_id", "value"))).alias("m"))
    return last.join(recent).join(values).select("ticker", "date", "close", F.array_join("news", ",").alias("news"), F.array_join(F.transform("m", lambda x: F.concat_ws("=", x["series_id"], F.round(x["value"], 2).cast("decimal(18,2)").cast("string"))), ",").alias("macro"))
