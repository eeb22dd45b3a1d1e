"""Queries on prices, series, sessions and correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsmarket.functions.text import fold
from newsmarket.operators import asof, calendar, correlate as corr, metrics, upsert, vectors

from .testbed import BENCHMARK, adapter, oracle, shared_folder, table

R = 4
QUERIES, SQL = {}, {}
UNIVERSE = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FINTECHS = ["Kueski", "Clip"]
PROXIES = [("banks", "3-MEDIUM", 0), ("banks", "1-URGENT", 1), ("retail", "5-LOW", 0)]
WANTED = ["1-URGENT", "3-MEDIUM", "5-LOW"]


def query(name: str, sql: str | None = None, *names: str):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = oracle(sql, *names)
        return f

    return keep


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, R) + F.lit(0.0) for c in columns})  # no negative zero


RET = """m AS (SELECT *, 100 * (adj_close / nullif(lag(adj_close) OVER w, 0) - 1) AS daily_return_pct FROM px WINDOW w AS (PARTITION BY ticker ORDER BY date))"""
MOVING = """
CASE WHEN count(*) OVER w7 = 7 THEN avg(adj_close) OVER w7 END AS ma_7d, CASE WHEN count(*) OVER w30 = 30 THEN avg(adj_close) OVER w30 END AS ma_30d,
CASE WHEN count(*) OVER w30 = 30 THEN stddev_samp(daily_return_pct) OVER w30 END AS volatility_30d"""
FRAMES = """WINDOW w7 AS (PARTITION BY ticker ORDER BY date ROWS 6 PRECEDING), w30 AS (PARTITION BY ticker ORDER BY date ROWS 29 PRECEDING)"""
REL = f"""{RET}, b AS (SELECT date, daily_return_pct AS bench FROM m WHERE ticker = '{BENCHMARK}'),
rel AS (SELECT m.*, CASE WHEN ticker <> '{BENCHMARK}' THEN bench END AS benchmark_return_pct, daily_return_pct - CASE WHEN ticker <> '{BENCHMARK}' THEN bench END AS excess_return_pct FROM m LEFT JOIN b USING (date))"""
BETA = """
CASE WHEN count(benchmark_return_pct) OVER w60 = 60 THEN covar_samp(daily_return_pct, benchmark_return_pct) OVER w60 / nullif(var_samp(benchmark_return_pct) OVER w60, 0) END AS beta_60d,
CASE WHEN count(benchmark_return_pct) OVER w60 = 60 THEN covar_samp(daily_return_pct, benchmark_return_pct) OVER w60 / nullif(
  stddev_samp(CASE WHEN benchmark_return_pct IS NOT NULL THEN daily_return_pct END) OVER w60 * stddev_samp(CASE WHEN daily_return_pct IS NOT NULL THEN benchmark_return_pct END) OVER w60, 0) END AS correlation_60d"""
W60 = "w60 AS (PARTITION BY ticker ORDER BY date ROWS 59 PRECEDING)"


@query("returns_ma_vol", f"WITH {RET}, f AS (SELECT *, {MOVING} FROM m {FRAMES}) SELECT ticker, date, round(daily_return_pct, {R}) AS daily_return_pct, round(ma_7d, {R}) AS ma_7d, round(ma_30d, {R}) AS ma_30d, round(volatility_30d, {R}) AS volatility_30d FROM f", "px")
def returns_ma_vol(spark, d):
    out = metrics.with_moving(metrics.with_returns(adapter(spark, d, "px")))
    cols = ["daily_return_pct", "ma_7d", "ma_30d", "volatility_30d"]
    return rounded(out.select("ticker", "date", *cols), *cols)


@query("metric_coverage", f"WITH {RET}, f AS (SELECT *, {MOVING} FROM m {FRAMES}) SELECT ticker, count(*) AS n_rows, count(daily_return_pct) AS n_daily_return_pct, count(ma_7d) AS n_ma_7d, count(ma_30d) AS n_ma_30d, count(volatility_30d) AS n_volatility_30d FROM f GROUP BY ticker", "px")
def metric_coverage(spark, d):
    return metrics.coverage(metrics.with_moving(metrics.with_returns(adapter(spark, d, "px"))), ["daily_return_pct", "ma_7d", "ma_30d", "volatility_30d"])


@query("relative_metrics", f"WITH {REL} SELECT ticker, date, round(benchmark_return_pct, {R}) AS benchmark_return_pct, round(excess_return_pct, {R}) AS excess_return_pct FROM rel", "px")
def relative_metrics(spark, d):
    out = metrics.with_benchmark(metrics.with_returns(adapter(spark, d, "px")), BENCHMARK)
    return rounded(out.select("ticker", "date", "benchmark_return_pct", "excess_return_pct"), "benchmark_return_pct", "excess_return_pct")


@query("beta_corr_60", f"WITH {REL}, f AS (SELECT *, {BETA} FROM rel WINDOW {W60}) SELECT ticker, date, round(beta_60d, {R}) + 0 AS beta_60d, round(correlation_60d, {R}) + 0 AS correlation_60d FROM f", "px")
def beta_corr_60(spark, d):
    out = metrics.with_beta(metrics.with_benchmark(metrics.with_returns(adapter(spark, d, "px")), BENCHMARK))
    return rounded(out.select("ticker", "date", "beta_60d", "correlation_60d"), "beta_60d", "correlation_60d")


ALL = ["daily_return_pct", "ma_7d", "ma_30d", "volatility_30d", "benchmark_return_pct", "excess_return_pct", "beta_60d", "correlation_60d"]


@query("market_metrics", f"WITH {REL}, f AS (SELECT *, {MOVING}, {BETA} FROM rel {FRAMES}, {W60}) SELECT ticker, date, close, volume, {', '.join(f'round({c}, {R}) + 0 AS {c}' for c in ALL)} FROM f", "px")
def market_metrics(spark, d):
    return rounded(metrics.market_metrics(adapter(spark, d, "px"), BENCHMARK).select("ticker", "date", "close", "volume", *ALL), *ALL)


@query("last_price", "SELECT ticker, max(date) AS date, max_by(close, date) AS close FROM px GROUP BY ticker", "px")
def last_price(spark, d):
    px = adapter(spark, d, "px")
    return px.groupBy("ticker").agg(F.max("date").alias("date"), F.max_by("close", "date").alias("close"))


@query("macro_yoy", f"""WITH y AS (SELECT s.series_id, s.date, s.value, p.value AS before FROM macro s
  ASOF LEFT JOIN macro p ON s.series_id = p.series_id AND s.date - INTERVAL 1 YEAR >= p.date)
SELECT series_id, date, round(value, {R}) AS value, round(100 * (value / nullif(before, 0) - 1), {R}) AS yoy_change_pct FROM y""", "macro")
def macro_yoy(spark, d):
    both = adapter(spark, d, "macro")
    out = metrics.yoy(both, ["series_id"], "date", ["value"])
    return rounded(out.select("series_id", "date", "value", F.col("value_yoy_pct").alias("yoy_change_pct")), "value", "yoy_change_pct")


@query("fundamentals_yoy", f"""WITH y AS (SELECT s.*, p.ingresos_totales AS i, p.utilidad_neta AS u FROM fund s
  ASOF LEFT JOIN fund p ON s.ticker = p.ticker AND s.period_end - INTERVAL 1 YEAR >= p.period_end)
SELECT ticker, period_end, round(100 * (ingresos_totales / nullif(i, 0) - 1), {R}) AS revenue_yoy_pct, round(100 * (utilidad_neta / nullif(u, 0) - 1), {R}) AS income_yoy_pct FROM y""", "fund")
def fundamentals_yoy(spark, d):
    out = metrics.yoy(adapter(spark, d, "fund"), ["ticker"], "period_end", ["ingresos_totales", "utilidad_neta"])
    out = out.select("ticker", "period_end", F.col("ingresos_totales_yoy_pct").alias("revenue_yoy_pct"), F.col("utilidad_neta_yoy_pct").alias("income_yoy_pct"))
    return rounded(out, "revenue_yoy_pct", "income_yoy_pct")


@query("asof_forward_price", """WITH t AS (SELECT o_orderkey AS id, o_orderpriority AS ticker, CAST(o_orderdate AS DATE) + 3 AS at_date FROM orders)
SELECT id, t.ticker, at_date, p.date AS price_date, p.close FROM t ASOF LEFT JOIN px p ON t.ticker = p.ticker AND t.at_date <= p.date""", "px")
def asof_forward_price(spark, d):
    t = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("ticker"), F.date_add(F.to_date("o_orderdate"), 3).alias("at_date"))
    prices = adapter(spark, d, "px").withColumnRenamed("date", "price_date")
    return asof.forward(t, prices, "ticker", "at_date", "price_date", ["close"])


LIST = ", ".join(f"'{w}'" for w in WANTED)
SNAP = f"""days AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events), s AS (SELECT d.date, m.series_id, max(m.date) AS value_date, max_by(m.value, m.date) AS value
  FROM days d JOIN macro m ON m.date <= d.date AND m.series_id IN ({LIST}) GROUP BY d.date, m.series_id)"""


@query("macro_snapshot", f"""WITH {SNAP} SELECT days.date, string_agg(series_id || '@' || CAST(value_date AS VARCHAR), ',' ORDER BY series_id) AS series, count(series_id) AS n_series, round(sum(value), 2) AS total
FROM days LEFT JOIN s USING (date) GROUP BY days.date""", "macro")
def macro_snapshot(spark, d):
    days = table(spark, d, "events").select(F.to_date("ts").alias("date"))
    got = asof.snapshot(days, adapter(spark, d, "macro"), WANTED)
    e = F.array_sort(F.map_entries("macro_context"))
    names = F.array_join(F.transform(e, lambda x: F.concat_ws("@", x["key"], x["value"]["date"].cast("string"))), ",")
    total = F.aggregate(e, F.lit(0.0), lambda s, x: s + x["value"]["value"])
    return got.select("date", names.alias("series"), F.coalesce(F.size(e), F.lit(0)).cast("long").alias("n_series"), F.round(total, 2).alias("total"))


@query("curve_slope", f"""WITH {SNAP}, p AS (SELECT date, max(CASE WHEN series_id = '1-URGENT' THEN value END) AS a, max(CASE WHEN series_id = '5-LOW' THEN value END) AS b FROM s GROUP BY date)
SELECT days.date, round((b - a) * 100, 1) AS slope_bp FROM days LEFT JOIN p USING (date)""", "macro")
def curve_slope(spark, d):
    days = table(spark, d, "events").select(F.to_date("ts").alias("date"))
    got = asof.snapshot(days, adapter(spark, d, "macro"), WANTED)
    return got.select("date", corr.curve_slope(F.col("macro_context"), "1-URGENT", "5-LOW").alias("slope_bp"))


NEXT = """dated AS (SELECT n.*, s.session_date AS next_session FROM n ASOF LEFT JOIN sessions s ON n.news_date < s.session_date)"""
DATES = """n AS (SELECT *, CAST(timezone('America/Mexico_City', timezone('UTC', published_at)) AS DATE) AS news_date FROM news)"""


def local_news(spark, d):
    local = F.to_date(F.from_utc_timestamp(F.col("published_at").cast("timestamp"), "America/Mexico_City"))
    return adapter(spark, d, "news").withColumn("news_date", local)


@query("next_session", f"WITH {DATES}, {NEXT} SELECT guid, news_date, next_session FROM dated", "news", "sessions")
def next_session(spark, d):
    return calendar.next_session(local_news(spark, d), "news_date", adapter(spark, d, "sessions")).select("guid", "news_date", "next_session")


@query("days_to_session", f"WITH {DATES}, {NEXT} SELECT guid, CAST(date_diff('day', news_date, next_session) AS INT) AS days_to_session FROM dated", "news", "sessions")
def days_to_session(spark, d):
    return calendar.next_session(local_news(spark, d), "news_date", adapter(spark, d, "sessions")).select("guid", "days_to_session")


@query("shift_sessions_5", "SELECT e.event_id, e.day, b.session_date AS after_5 FROM (SELECT event_id, CAST(ts AS DATE) AS day FROM events) e LEFT JOIN sessions a ON a.session_date = e.day LEFT JOIN sessions b ON b.session_no = a.session_no + 5", "sessions")
def shift_sessions_5(spark, d):
    e = table(spark, d, "events").select("event_id", F.to_date("ts").alias("day"))
    return calendar.shift_sessions(e, "day", 5, adapter(spark, d, "sessions"), "after_5").select("event_id", "day", "after_5")


@query("sessions_between", "SELECT session_date, session_no FROM sessions WHERE session_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'", "sessions")
def sessions_between(spark, d):
    return calendar.sessions_between(adapter(spark, d, "sessions"), "1995-01-01", "1996-12-31")


@query("weekend_news", f"WITH {DATES} SELECT guid, news_date FROM n WHERE dayofweek(news_date) IN (5, 6, 0)", "news")
def weekend_news(spark, d):
    return calendar.on_weekend_edge(local_news(spark, d), "news_date").select("guid", "news_date")


@query("closed_bars_only", """WITH l AS (SELECT event_id, timezone('America/Mexico_City', timezone('UTC', ts)) AS t FROM events) SELECT event_id FROM l WHERE dayofweek(t) IN (0, 6) OR hour(t) >= 15""")
def closed_bars_only(spark, d):
    return calendar.closed_bars(table(spark, d, "events"), "ts").select("event_id")


@query("news_on_local_date", f"WITH {DATES} SELECT guid, news_date AS local_date FROM n WHERE news_date BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'", "news")
def news_on_local_date(spark, d):
    return calendar.on_local_date(adapter(spark, d, "news"), "published_at", "1996-01-01", "1997-06-30").select("guid", "local_date")


TARGETS = f"""k AS (SELECT guid, sector, CASE WHEN fintech IN ('Kueski', 'Clip') THEN fintech END AS label, list_sort(list_distinct(list_filter([model_ticker, lexicon_ticker], lambda x: x IN ({", ".join(f"'{u}'" for u in UNIVERSE)})))) AS direct FROM n),
proxies(sector, proxy, pos) AS (VALUES {", ".join(map(str, PROXIES))}),
targets AS (SELECT guid, unnest(direct) AS ticker, 'direct' AS relation, CAST(NULL AS VARCHAR) AS label FROM k
  UNION ALL SELECT guid, proxy, 'proxy', label FROM k JOIN proxies USING (sector) WHERE NOT list_contains(direct, proxy))"""


def _targets(spark, news):
    one = lambda c: F.when(F.col(c).isNotNull(), F.array(c))
    null = F.lit(None).cast("array<string>")
    n = news.select("guid", one("model_ticker").alias("model_tickers"), one("lexicon_ticker").alias("lexicon_tickers"), one("fintech").alias("fintechs"), null.alias("lexicon_fintechs"), "sector", F.lit(None).cast("string").alias("lexicon_sector"))
    return corr.targets(n, UNIVERSE, spark.createDataFrame(PROXIES, "sector string, proxy string, pos int"), spark.createDataFrame([(x,) for x in FINTECHS], "name string"))


@query("targets_direct_proxy", f"WITH {DATES}, {TARGETS} SELECT guid, ticker, relation, label FROM targets", "news")
def targets_direct_proxy(spark, d):
    return _targets(spark, local_news(spark, d))


CORR = f"""{DATES}, {NEXT}, {TARGETS}, {RET}, a AS (SELECT d.guid, d.news_date, d.next_session, t.ticker, t.relation, t.label FROM dated d JOIN targets t USING (guid) WHERE next_session IS NOT NULL),
r AS (SELECT a.*, p.date AS price_date, p.close, p.daily_return_pct AS next_day_return_pct FROM a ASOF JOIN m p ON a.ticker = p.ticker AND a.next_session <= p.date),
c AS (SELECT r.*, 100 * (q.close / nullif(r.close, 0) - 1) AS change_5d_pct FROM r LEFT JOIN sessions s ON s.session_date = r.price_date LEFT JOIN sessions s5 ON s5.session_no = s.session_no + 5 LEFT JOIN m q ON q.ticker = r.ticker AND q.date = s5.session_date),
ctx AS (SELECT d.news_date, count(DISTINCT x.series_id) AS n_macro FROM (SELECT DISTINCT news_date FROM n) d LEFT JOIN macro x ON x.date <= d.news_date AND x.series_id IN ({LIST}) GROUP BY 1)"""
FOUR = ("news", "sessions", "px", "macro")


def correlations(spark, d):
    news = local_news(spark, d)
    prices = metrics.with_returns(adapter(spark, d, "px"))
    sessions = adapter(spark, d, "sessions")
    found = _targets(spark, news)
    return news, found, sessions, corr.correlate(news.select("guid", "news_date"), found, prices, sessions, adapter(spark, d, "macro"), WANTED)


@query("correlate", f"WITH {CORR} SELECT guid, ticker, relation, label, news_date, next_session, price_date, close, round(next_day_return_pct, {R}) AS next_day_return_pct, round(change_5d_pct, {R}) AS change_5d_pct, n_macro FROM c JOIN ctx USING (news_date)", *FOUR)
def correlate(spark, d):
    out = correlations(spark, d)[3].withColumn("n_macro", F.coalesce(F.size("macro_context"), F.lit(0)).cast("long"))
    return rounded(out.select("guid", "ticker", "relation", "label", "news_date", "next_session", "price_date", "close", "next_day_return_pct", "change_5d_pct", "n_macro"), "next_day_return_pct", "change_5d_pct")


@query("uncorrelated_reasons", f"""WITH {CORR} SELECT CASE WHEN guid IN (SELECT guid FROM c) THEN 'correlated' WHEN guid NOT IN (SELECT guid FROM targets) THEN 'no_target' WHEN next_session IS NULL THEN 'outside_calendar' ELSE 'no_price' END AS reason, count(*) AS n_news FROM dated GROUP BY 1""", *FOUR)
def uncorrelated_reasons(spark, d):
    news, found, sessions, result = correlations(spark, d)
    return corr.reasons(news.select("guid", "news_date"), found, result, sessions)


@query("negative_then_fall", f"WITH {CORR} SELECT c.guid, c.ticker, c.relation, c.price_date, round(c.next_day_return_pct, {R}) AS next_day_return_pct, n.title FROM c JOIN n USING (guid) WHERE n.sentiment = 'negative' AND c.next_day_return_pct < -2", *FOUR)
def negative_then_fall(spark, d):
    news, _, _, result = correlations(spark, d)
    out = corr.negative_then_fall(result, news)
    return rounded(out.select("guid", "ticker", "relation", "price_date", "next_day_return_pct", "title"), "next_day_return_pct")


@query("largest_move", f"WITH {CORR} SELECT guid, ticker, price_date, round(next_day_return_pct, {R}) AS next_day_return_pct FROM c WHERE next_day_return_pct IS NOT NULL ORDER BY abs(next_day_return_pct) DESC, guid, ticker LIMIT 1", *FOUR)
def largest_move(spark, d):
    out = correlations(spark, d)[3].where("next_day_return_pct is not null").orderBy(F.desc(F.abs("next_day_return_pct")), "guid", "ticker").limit(1)
    return rounded(out.select("guid", "ticker", "price_date", "next_day_return_pct"), "next_day_return_pct")


@query("market_context", f"""WITH {CORR} SELECT '1-URGENT' AS ticker, max(date) AS date, max_by(close, date) AS close,
(SELECT string_agg(guid, ',' ORDER BY guid) FROM (SELECT guid FROM c WHERE ticker = '1-URGENT' ORDER BY price_date DESC, guid LIMIT 20)) AS news,
(SELECT string_agg(series_id || '=' || CAST(CAST(round(v, 2) AS DECIMAL(18,2)) AS VARCHAR), ',' ORDER BY series_id) FROM (SELECT series_id, max_by(value, date) AS v FROM macro GROUP BY 1)) AS macro
FROM px WHERE ticker = '1-URGENT'""", *FOUR)
def market_context(spark, d):
    result = correlations(spark, d)[3]
    return corr.market_context(adapter(spark, d, "px"), result, adapter(spark, d, "macro"), "1-URGENT")


UNIT = "v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), u AS (SELECT vec_id, e, CASE WHEN list_sum(list_transform(e, lambda x: x * x)) = 0 THEN 1.0 ELSE sqrt(list_sum(list_transform(e, lambda x: x * x))) END AS n FROM v)"


@query("l2_normalize", f"WITH {UNIT} SELECT vec_id, len(e) AS dim, round(e[1] / n, {R}) AS first, round(e[-1] / n, {R}) AS last, round(list_sum(list_transform(e, lambda x: (x / n) * (x / n))), {R}) AS norm FROM u")
def l2_normalize(spark, d):
    v = table(spark, d, "embeddings").withColumn("u", vectors.normalised(F.col("embedding")))
    out = v.select("vec_id", F.size("u").cast("long").alias("dim"), F.element_at("u", 1).alias("first"), F.element_at("u", -1).alias("last"), vectors.dot(F.col("u"), F.col("u")).alias("norm"))
    return rounded(out, "first", "last", "norm")


@query("wrong_size", "SELECT vec_id FROM embeddings WHERE vec_id % 10 IN (0, 1)")
def wrong_size(spark, d):
    i = F.col("vec_id") % 10
    v = table(spark, d, "embeddings").withColumn("embedding", F.when(i == 0, F.slice("embedding", 1, 8)).when(i > 1, F.col("embedding")))
    return vectors.wrong_size(v, 64).select("vec_id")


def _top(extra: str = "", qs: str = "0", k: int = 10) -> str:
    return f"""WITH {UNIT}, s AS (SELECT q.vec_id AS query_id, u.vec_id, list_dot_product(u.e, q.e) / (u.n * q.n) AS score FROM u, u q WHERE q.vec_id IN ({qs}) {extra}),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s) SELECT * REPLACE (round(score, {R}) AS score) FROM r WHERE rank <= {k}"""


def vector_of(spark, d, vec_id):
    """The vector asked for; without one, none, which nothing is near to."""
    found = table(spark, d, "embeddings").where(F.col("vec_id") == vec_id).select("embedding").first()
    return found[0] if found else []


@query("cosine_topk", f"SELECT vec_id, score, rank, label FROM ({_top()}) JOIN embeddings USING (vec_id)")
def cosine_topk(spark, d):
    v = table(spark, d, "embeddings")
    return rounded(vectors.top_k(v, vector_of(spark, d, 0), 10), "score").join(v.select("vec_id", "label"), "vec_id")


@query("cosine_topk_multi", _top(qs="0, 1, 2, 3, 4"))
def cosine_topk_multi(spark, d):
    v = table(spark, d, "embeddings")
    return rounded(vectors.top_k_many(v, v.where("vec_id < 5").select(F.col("vec_id").alias("query_id"), "embedding"), 10), "score")


@query("cosine_topk_twentieth", _top(qs="SELECT vec_id FROM embeddings WHERE vec_id % 20 = 0"))
def cosine_topk_twentieth(spark, d):
    v = table(spark, d, "embeddings")
    return rounded(vectors.top_k_many(v, v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), 10, folder=shared_folder(spark)), "score")


@query("hybrid_topk", f"SELECT vec_id, score, rank FROM ({_top('AND u.vec_id IN (SELECT vec_id FROM embeddings WHERE label = 3)')})")
def hybrid_topk(spark, d):
    v = table(spark, d, "embeddings")
    return rounded(vectors.top_k(v.where("label = 3"), vector_of(spark, d, 0), 10), "score")
