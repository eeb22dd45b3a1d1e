"""Data-quality checks as rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assert_table(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule, n_violations: rows for which a rule is false (null passes, as in a CHECK); one pass over the table."""
    counts = df.agg(*[F.count_if(~c).alias(name) for name, c in rules.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("n_violations")) for name in rules])
    return counts.select(F.explode(pairs).alias("r")).select("r.*")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()])


def count_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """table_name, n_before, n_after, n_added: proof that a rerun adds nothing."""
    both = before.withColumnRenamed("n_rows", "n_before").join(after.withColumnRenamed("n_rows", "n_after"), "table_name", "full_outer")
    return both.withColumn("n_added", F.coalesce("n_after", F.lit(0)) - F.coalesce("n_before", F.lit(0)))


def fingerprints(df: DataFrame, keys: list[str], buckets: int = 256, by: Column | None = None) -> DataFrame:
    """bucket, n_rows, sum_a, xor_b: what the rows of each bucket of keys hold, whatever their order; partial sums only. Buckets are of a hash of the keys, or ``by``."""
    columns = sorted(df.columns)
    nulls = F.concat(*[F.isnull(c).cast("int").cast("string") for c in columns])
    a, b = F.xxhash64(*columns, nulls), F.xxhash64(F.lit(1), *columns, nulls)
    rows = df.select((F.pmod(F.xxhash64(*keys), F.lit(buckets)) if by is None else by).alias("bucket"), a.cast("decimal(20,0)").alias("a"), b.alias("b"))
    return rows.groupBy("bucket").agg(F.count("*").alias("n_rows"), F.sum("a").alias("sum_a"), F.bit_xor("b").alias("xor_b"))


def content_diff(before: DataFrame, after: DataFrame, keys: list[str], buckets: int = 256, by: Column | None = None) -> DataFrame:
    """bucket, n_before, n_after of the buckets of keys whose rows differ: none if a rerun changes nothing."""
    x, y = (fingerprints(df, keys, buckets, by) for df in (before, after))
    both = x.alias("x").join(y.alias("y"), "bucket", "full_outer")
    same = F.col("x.n_rows").eqNullSafe(F.col("y.n_rows")) & F.col("x.sum_a").eqNullSafe(F.col("y.sum_a")) & F.col("x.xor_b").eqNullSafe(F.col("y.xor_b"))
    return both.where(~same).select("bucket", F.coalesce("x.n_rows", F.lit(0)).alias("n_before"), F.coalesce("y.n_rows", F.lit(0)).alias("n_after"))


@dataclass(frozen=True)
class Check:
    """A criterion over a table's rows: aggregates ok (boolean; a null is WARN: there is nothing to show it with) and evidence."""

    table: DataFrame
    ok: Column
    evidence: Column


def report(checks: dict[str, Check]) -> DataFrame:
    """criterion, status, evidence: checks on the same table (the same DataFrame) are made in one pass over it."""
    tables = {id(c.table): c.table for c in checks.values()}

    def of(df: DataFrame) -> DataFrame:
        some = {name: c for name, c in checks.items() if c.table is df}
        got = df.agg(*[c.alias(f"{part}{k}") for k, check in enumerate(some.values()) for part, c in (("ok", check.ok), ("n", check.evidence.cast("long")))])
        status = lambda ok: F.when(ok.isNull(), "WARN").when(ok, "PASS").otherwise("FAIL")
        rows = [F.struct(F.lit(name).alias("criterion"), status(F.col(f"ok{k}")).alias("status"), F.col(f"n{k}").alias("evidence")) for k, name in enumerate(some)]
        return got.select(F.explode(F.array(*rows)).alias("r")).select("r.*")

    return reduce(DataFrame.unionByName, map(of, tables.values()))


def at_least(df: DataFrame, condition: Column, least: int = 1) -> Check:
    """So many rows meet a condition; their number is the evidence."""
    return Check(df, F.count_if(condition) >= least, F.count_if(condition))


def none_of(df: DataFrame, condition: Column) -> Check:
    """No row meets a condition."""
    return Check(df, F.count_if(condition) == 0, F.count_if(condition))


def all_of(df: DataFrame, condition: Column, among: Column | None = None) -> Check:
    """There are rows (``among`` those that meet a condition) and each meets a condition; without rows it is a WARN."""
    among = F.lit(True) if among is None else among
    return Check(df, F.when(F.count_if(among) > 0, F.count_if(among & condition) == F.count_if(among)), F.count_if(among))


def under(df: DataFrame, measure: Column, limit: float) -> Check:
    """A check that only warns: the mean of a measure is under a limit."""
    mean = F.round(F.avg(measure)).cast("long")
    return Check(df, F.when(mean < limit, True), mean)


def acceptance(batches: DataFrame, checked: DataFrame, enriched: DataFrame, correlated: DataFrame, counts: DataFrame, index: DataFrame, hits: DataFrame, sources: int = 5) -> DataFrame:
    """The acceptance criteria of a run as rows.

    batches: source, date, damaged; checked: as a contract returns it, with guid and macro_bypass;
    enriched: sentiment, ma_event, fintech_flag, companies; correlated: relation, news_date,
    next_session, price_date, next_day_return_pct; counts: as ``count_diff`` gives them; index: one
    row an indexed vector; hits: one row a search result, with milliseconds ``ms`` if they were measured.
    """
    # A row a guid of what is valid, and one for what has no place in that count, so one pass serves the checks on rows and on guids.
    valid, bypassed = F.col("rejection_reason").isNull(), F.col("rejection_reason").isNull() & F.col("macro_bypass")
    by_guid = checked.groupBy(valid.alias("valid"), F.when(valid, F.col("guid")).alias("guid")).agg(F.count("*").alias("n"), F.count_if(F.col("rejection_reason") == "MISSING_ENTITY").alias("missing"), F.count_if(bypassed).alias("bypassed"))
    missing, bypassed = (F.coalesce(F.sum(c), F.lit(0)) for c in ("missing", "bypassed"))
    per_day = batches.groupBy("source", "date").agg(F.count("*").alias("n"), F.count_if("damaged").alias("damaged"))
    damaged = F.coalesce(F.sum("damaged"), F.lit(0))
    weekend = F.dayofweek("news_date").isin(6, 7, 1)
    resolved = (F.col("next_session") > F.col("news_date")) & ~F.dayofweek("next_session").isin(7, 1) & (F.col("price_date") >= F.col("next_session"))
    always, seen = F.lit(True), F.size(F.collect_set("source"))
    fast = {"search_under_500_ms": under(hits, F.col("ms"), 500)} if "ms" in hits.columns else {}
    return report(
        {
            "bronze_sources": Check(per_day, seen >= sources, seen),
            "bronze_several_batches_a_day": at_least(per_day, F.col("n") > 1),
            "bronze_intact": Check(per_day, damaged == 0, damaged),
            "contract_missing_entity": Check(by_guid, missing >= 1, missing),
            "contract_macro_bypass": Check(by_guid, bypassed >= 1, bypassed),
            "unique_guids": none_of(by_guid, F.col("valid") & (F.col("n") > 1)),
            "rerun_adds_nothing": none_of(counts, F.col("n_added") != 0),
            "names_found": at_least(enriched, F.size("companies") > 0),
            "sentiment_assigned": all_of(enriched, F.col("sentiment").isNotNull()),
            "deals_found": at_least(enriched, F.col("ma_event")),
            "fintechs_tagged": at_least(enriched, F.col("fintech_flag")),
            "proxies_used": at_least(correlated, F.col("relation") == "proxy"),
            "weekend_to_session": all_of(correlated, resolved, weekend),
            "returns_correlated": at_least(correlated, F.col("next_day_return_pct").isNotNull()),
            "index_filled": at_least(index, always),
            "search_answers": at_least(hits, always),
            **fast,
        }
    )


# The rules that the tables' own checks state, for assert_table.


def news_rules(sources: list[str]) -> dict[str, Column]:
    """Of validated news."""
    filled = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    entity = F.col("macro_bypass") | filled("tickers") | F.coalesce(F.length("sector") > 0, F.lit(False)) | filled("entities")
    return {"guid_sha256": F.col("guid").rlike("^[0-9a-f]{64}$"), "known_source": F.col("source").isin(sources), "title_length": F.length("title").between(1, 1024), "content_length": F.length("content").between(1, 8192), "entity_or_bypass": F.coalesce(entity, F.lit(False))}


def rejection_rules(reasons: tuple[str, ...] = ("MISSING_ENTITY", "TYPE_MISMATCH", "INVALID_URL", "INVALID_DATE", "MISSING_FIELD", "OUT_OF_RANGE", "DUPLICATE_KEY", "UNKNOWN_SOURCE")) -> dict[str, Column]:
    """Of the quarantine."""
    return {"known_reason": F.col("rejection_reason").isin(list(reasons))}


def price_rules() -> dict[str, Column]:
    positive = F.lit(True)
    for c in ("open", "high", "low", "close", "adj_close"):
        positive = positive & (F.col(c) > 0)
    low, high = F.col("low"), F.col("high")
    return {"positive_prices": positive, "volume_not_negative": F.col("volume") >= 0, "day_range": (low <= high) & F.col("open").between(low, high) & F.col("close").between(low, high)}


def fundamental_rules(measures: tuple[str, ...]) -> dict[str, Column]:
    return {"assets_positive": F.col("activo_total") > 0, "liabilities_not_negative": F.col("pasivo_total") >= 0, "some_measure": F.coalesce(*measures).isNotNull()}


def enriched_rules(kinds: list[str]) -> dict[str, Column]:
    """Of enriched news: sentiment, its score, and deals whose kind is none unless there is one."""
    return {
        "known_sentiment": F.col("sentiment").isin("positive", "negative", "neutral"),
        "sentiment_score_range": F.col("sentiment_score").between(0, 1),
        "known_deal": F.col("ma_kind").isin(kinds),
        "deal_score_range": F.col("ma_score").between(0, 1),
        "deal_coherent": F.col("ma_event") | (F.col("ma_kind") == "none"),
    }


def correlation_rules() -> dict[str, Column]:
    """Of correlations: a proxy has a ticker in its place, a direct one has none, and no price is before its news."""
    return {"proxy_coherent": F.col("is_proxy") == F.col("proxy_ticker").isNotNull(), "price_after_news": F.col("price_date") >= F.col("news_date")}


def samples(df: DataFrame, by: str, order: list[str], n: int) -> DataFrame:
    """Up to ``n`` rows of each value of ``by``."""
    from pyspark.sql import Window

    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= n)
