"""Queries on upserts, quarantine, replies, sources, streams and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsmarket.functions import text
from newsmarket.operators import partitioned, quality, replies, upsert, vectors
from newsmarket.sources import bronze, feeds
from newsmarket.streaming import incremental

from .market import CORR, FOUR, correlations, vector_of as correlation_vector
from .testbed import adapter, oracle, shared_folder, table
from .text import CHECKED, SOURCES, TERMS, TRUSTED, checked_news

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None, *names: str):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = oracle(sql, *names)
        return f

    return keep


# Orders before 1997 are the target; those from 1996 on, with their customer as key, come as updates.
SIDES = """t AS (SELECT o_custkey AS k, max_by(o_totalprice, o_orderkey) AS v, max_by(o_orderpriority, o_orderkey) AS w, min_by(o_orderdate, o_orderkey) AS first_seen FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 1),
u AS (SELECT o_custkey AS k, max_by(o_totalprice, o_orderkey) AS v, max_by(o_orderpriority, o_orderkey) AS w, min_by(o_orderdate, o_orderkey) AS first_seen FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1)"""


def _sides(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"), F.col("o_orderpriority").alias("w"), F.col("o_orderdate").alias("first_seen"), "o_orderkey")
    at = lambda s: F.to_timestamp_ntz(F.lit(s))
    target = upsert.collapse(o.where(F.col("first_seen") < at("1997-01-01 00:00:00")), ["k"], ["o_orderkey"], ["v", "w"], ["first_seen"])
    return target, o.where(F.col("first_seen") >= at("1996-01-01 00:00:00"))


ARGS = (["k"], ["v", "w"], ["first_seen"], ["o_orderkey"])


@query("upsert_news", f"WITH {SIDES} SELECT k, CASE WHEN u.v IS NULL THEN t.v ELSE u.v END AS v, CASE WHEN u.v IS NULL THEN t.w ELSE u.w END AS w, coalesce(t.first_seen, u.first_seen) AS first_seen FROM t FULL JOIN u USING (k)")
def upsert_news(spark, d):
    return upsert.upsert(*_sides(spark, d), *ARGS)


@query("upsert_counts", f"WITH {SIDES} SELECT count(*) FILTER (t.v IS NULL) AS n_new, count(*) FILTER (t.v IS NOT NULL AND u.v IS NOT NULL) AS n_updated, count(*) AS n_rows FROM t FULL JOIN u USING (k)")
def upsert_counts(spark, d):
    return upsert.upsert_counts(*_sides(spark, d), *ARGS)


@query("upsert_series", """SELECT coalesce(a.ticker, b.ticker) AS ticker, coalesce(a.date, b.date) AS date, coalesce(b.close, a.close) AS close, CASE WHEN a.date IS NULL THEN 'new' ELSE 'old' END AS first_batch
FROM (SELECT * FROM px WHERE date < DATE '1996-06-01') a FULL JOIN (SELECT ticker, date, close + 1 AS close FROM px WHERE date >= DATE '1996-01-01') b ON a.ticker = b.ticker AND a.date = b.date""", "px")
def upsert_series(spark, d):
    px = adapter(spark, d, "px").select("ticker", "date", "close")
    old = px.where("date < date '1996-06-01'").withColumn("first_batch", F.lit("old"))
    new = px.where("date >= date '1996-01-01'").withColumn("close", F.col("close") + 1).withColumn("first_batch", F.lit("new"))
    return upsert.upsert(old, new, ["ticker", "date"], ["close"], ["first_batch"], ["date"])


@query("upsert_touched", """WITH a AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, o_totalprice AS v, 'old' AS first_batch FROM orders WHERE o_orderkey % 5 <> 0),
b AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, o_totalprice + 1 AS v, 'new' AS first_batch FROM orders WHERE o_orderdate >= TIMESTAMP '1996-05-01' AND o_orderdate < TIMESTAMP '1996-07-01'),
m AS (SELECT k, day, coalesce(b.v, a.v) AS v, coalesce(a.first_batch, b.first_batch) AS first_batch, a.k IS NULL AS is_new, a.k IS NOT NULL AND b.k IS NOT NULL AS is_old FROM a FULL JOIN b USING (k, day))
SELECT strftime(day, '%Y-%m') AS part, count(*) AS n_rows, max(v) AS highest, count(*) FILTER (first_batch = 'new') AS n_added, any_value(t.n_new) AS n_new, any_value(t.n_updated) AS n_updated, any_value(t.n_partitions) AS n_partitions
FROM m, (SELECT count(*) FILTER (is_new) AS n_new, count(*) FILTER (is_old) AS n_updated, count(DISTINCT CASE WHEN is_new OR is_old THEN strftime(day, '%Y-%m') END) AS n_partitions FROM m) t GROUP BY 1""")
def upsert_touched(spark, d):
    """A target partitioned by month; a batch of two months reads and rewrites these only. Run twice, with equal results."""
    path = shared_folder(spark)
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("v"))
    args, by = (["k", "day"], ["v"], ["first_batch"], ["v"]), F.date_format("day", "yyyy-MM")
    partitioned.upsert_into(f"{path}/orders", o.where("k % 5 <> 0").withColumn("first_batch", F.lit("old")), *args, by, f"{path}/work")
    batch = o.where("day >= date '1996-05-01' and day < date '1996-07-01'").withColumn("v", F.col("v") + 1).withColumn("first_batch", F.lit("new"))
    done = partitioned.upsert_into(f"{path}/orders", batch, *args, by, f"{path}/work")
    partitioned.upsert_into(f"{path}/orders", batch, *args, by, f"{path}/work")
    now = partitioned.read_table(spark, f"{path}/orders", batch.select("k", "day", "v", "first_batch").schema)
    counts = {"n_new": done.n_new, "n_updated": done.n_updated, "n_partitions": len(done.partitions)}
    out = now.groupBy("part").agg(F.count("*").alias("n_rows"), F.max("v").alias("highest"), F.count_if(F.col("first_batch") == "new").alias("n_added"))
    return out.withColumns({k: F.lit(v).cast("long") for k, v in counts.items()})


@query("upsert_gold_news", """SELECT doc_id AS guid, md5(text) AS title, CASE WHEN doc_id % 4 = 0 THEN 'new' ELSE 'old' END AS sentiment FROM documents WHERE doc_id % 2 = 0
UNION ALL SELECT doc_id, 'changed', 'new' FROM documents WHERE doc_id % 2 = 1 AND doc_id % 3 = 0""")
def upsert_gold_news(spark, d):
    x = table(spark, d, "documents").select(F.col("doc_id").alias("guid"), F.md5("text").alias("title"))
    old = x.where("guid % 2 = 0").withColumn("sentiment", F.lit("old"))
    new = x.where("guid % 4 = 0 or (guid % 2 = 1 and guid % 3 = 0)").withColumn("title", F.lit("changed")).withColumn("sentiment", F.lit("new"))
    return upsert.upsert(old, new, ["guid"], ["sentiment"], ["title"], ["guid"])


LETTERS = """rej AS (SELECT event_type AS source, CASE WHEN user_id % 10 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS guid, 'R' || (event_id % 3) AS reason, 'd' || (event_id % 7) AS detail, props AS payload, CAST(event_id % 5 AS VARCHAR) AS batch, ts AS rejected_at, event_id AS id FROM events)"""


def _letters(spark, d):
    u = F.col("user_id")
    return table(spark, d, "events").select(F.col("event_type").alias("source"), F.when(u % 10 != 0, u.cast("string")).alias("guid"), F.concat(F.lit("R"), (F.col("event_id") % 3).cast("string")).alias("reason"), F.concat(F.lit("d"), (F.col("event_id") % 7).cast("string")).alias("detail"), F.col("props").alias("payload"), (F.col("event_id") % 5).cast("string").alias("batch"), F.col("ts").alias("rejected_at"), F.col("event_id").alias("id"))


@query("dead_letter_merge", f"""WITH {LETTERS} SELECT source, guid, l.reason AS reason, l.detail AS detail, l.batch AS batch, times_rejected, first_rejected_at FROM (SELECT source, guid, max_by({{'reason': reason, 'detail': detail, 'batch': batch}}, (rejected_at, reason, detail, payload, batch)) AS l, count(*) AS times_rejected, min(rejected_at) AS first_rejected_at FROM rej WHERE guid IS NOT NULL GROUP BY ALL) UNION ALL SELECT source, NULL, reason, detail, batch, 1, rejected_at FROM rej WHERE guid IS NULL""")
def dead_letter_merge(spark, d):
    r = _letters(spark, d)
    first, second = r.where("id % 2 = 0").drop("id"), r.where("id % 2 = 1").drop("id")
    empty = first.limit(0).select("source", "guid", "reason", "detail", "payload", "batch", F.lit(0).cast("long").alias("times_rejected"), F.col("rejected_at").alias("first_rejected_at"), "rejected_at")
    out = upsert.dead_letters(upsert.dead_letters(empty, first), second)
    return out.select("source", "guid", "reason", "detail", "batch", "times_rejected", "first_rejected_at")


@query("dead_letter_collapse", f"WITH {LETTERS} SELECT source, guid, min(id) AS id, min(rejected_at) AS first_rejected_at, max(rejected_at) AS last_rejected_at, count(*) AS times_rejected, max_by(reason, (rejected_at, id)) AS reason, max_by(detail, (rejected_at, id)) AS detail, max_by(batch, (rejected_at, id)) AS batch FROM rej WHERE guid IS NOT NULL GROUP BY ALL")
def dead_letter_collapse(spark, d):
    return upsert.collapse_dead_letters(_letters(spark, d)).drop("payload")


@query("pending_scan", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 30) ORDER BY o_orderdate DESC, o_orderkey LIMIT 100")
def pending_scan(spark, d):
    done = table(spark, d, "lineitem").where("l_quantity > 30").select(F.col("l_orderkey").alias("o_orderkey"))
    return upsert.pending(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), done, "o_orderkey", "o_orderdate", 100)


@query("pending_scan_all", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 30)")
def pending_scan_all(spark, d):
    done = table(spark, d, "lineitem").where("l_quantity > 30").select(F.col("l_orderkey").alias("o_orderkey"))
    return upsert.pending(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), done, "o_orderkey", "o_orderdate")


@query("mark_processed", "SELECT doc_id, doc_id % 3 <> 2 AND doc_id % 5 <> 0 AS enriched FROM documents")
def mark_processed(spark, d):
    x = table(spark, d, "documents").select("doc_id")
    results = x.where("doc_id % 5 <> 0").withColumn("errors", F.col("doc_id") % 3)
    return upsert.mark_processed(x, results, "doc_id")


@query("duplicate_keys", "SELECT o_custkey, o_orderpriority, count(*) AS n_rows FROM orders GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return upsert.duplicate_keys(table(spark, d, "orders"), ["o_custkey", "o_orderpriority"])


@query("idempotence_diff", f"WITH {SIDES}, m AS (SELECT count(*) AS n FROM t FULL JOIN u USING (k)) SELECT 'customers' AS table_name, n AS n_before, n AS n_after, CAST(0 AS BIGINT) AS n_added FROM m UNION ALL SELECT 'orders', count(*), count(*), 0 FROM orders")
def idempotence_diff(spark, d):
    target, updates = _sides(spark, d)
    once = upsert.upsert(target, updates, *ARGS)
    twice = upsert.upsert(once, updates, *ARGS)
    orders = table(spark, d, "orders")
    return quality.count_diff(quality.row_counts({"customers": once, "orders": orders}), quality.row_counts({"customers": twice, "orders": orders}))


@query("content_diff", f"WITH {SIDES} SELECT 'rerun' AS what, CAST(0 AS BIGINT) AS n_buckets, CAST(0 AS BIGINT) AS n_before, CAST(0 AS BIGINT) AS n_after UNION ALL SELECT 'one value', 1, n, n FROM (SELECT count(*) AS n FROM t FULL JOIN u USING (k) WHERE k % 64 = (SELECT min(k) % 64 FROM (SELECT k FROM t UNION SELECT k FROM u)))")
def content_diff(spark, d):
    """By content: an upsert that runs again changes nothing; one changed value is found, in one bucket of keys."""
    target, updates = _sides(spark, d)
    once = upsert.upsert(target, updates, *ARGS)
    again = upsert.upsert(once, updates, *ARGS)
    low = once.agg(F.min("k").alias("low"))
    touched = once.join(F.broadcast(low)).withColumn("v", F.when(F.col("k") == F.col("low"), F.col("v") + 0.01).otherwise(F.col("v"))).drop("low")
    totals = lambda name, diff: diff.agg(F.count("*").alias("n_buckets"), F.coalesce(F.sum("n_before"), F.lit(0)).alias("n_before"), F.coalesce(F.sum("n_after"), F.lit(0)).alias("n_after")).select(F.lit(name).alias("what"), "n_buckets", "n_before", "n_after")
    return totals("rerun", quality.content_diff(once, again, ["k"])).unionByName(totals("one value", quality.content_diff(once, touched, ["k"], by=F.pmod(F.col("k"), F.lit(64)))))


# Replies made from ids, with fences, bare words, unknown labels and scores out of range.
def _replies(spark, d):
    i = F.col("doc_id")
    ticker = F.when(i % 4 == 0, "GFNORTE").otherwise('"GFNORTE"')
    ner = F.concat(F.lit('{"tickers": ['), ticker, F.lit(', "INVENTED", " GFNORTE ", 7, {"a": 1}], "sectores": ["banks", "moon"], "personas": '), F.when(i % 13 == 0, '{"a": "Ana"}').when(i % 13 == 1, '"Ana"').otherwise('["Ana", " Ana ", ""]'), F.lit(', "empresas": ["Acme "], "sentimiento": "'), F.when(i % 3 == 0, "Positive").when(i % 3 == 1, "angry").otherwise("negative"), F.lit('", "confianza_sentimiento": '), F.when(i % 5 == 0, "1.7").when(i % 5 == 1, "-3").when(i % 5 == 2, '"0.8"').when(i % 5 == 3, '"high"').otherwise("0.5"), F.lit("}"))
    ner = F.when(i % 7 == 0, F.concat(F.lit("```json\n"), ner, F.lit("\n```"))).when(i % 11 == 0, F.lit("no json")).otherwise(ner)
    ma = F.concat(F.lit('{"es_evento_ma": '), F.when(i % 2 == 0, "true").when(i % 3 == 0, '"false"').otherwise("false"), F.lit(', "tipo_ma": "'), F.when(i % 4 == 0, "merger").when(i % 4 == 2, "none").when(i % 9 == 0, "acquisition").otherwise("odd"), F.lit('", "confianza_ma": 0.4, "fintechs": ["'), F.when(i % 3 == 0, "Clip").otherwise("Nobody"), F.lit('"], "sector_afectado": '), F.when(i % 5 == 0, '"banks"').otherwise("null"), F.lit("}"))
    x = table(spark, d, "documents")
    return x.select("doc_id", F.lit("ner").alias("pass"), ner.alias("reply_text")).unionByName(x.select("doc_id", F.lit("ma").alias("pass"), ma.alias("reply_text")))


@query("parse_repair_json", "SELECT doc_id, doc_id % 7 = 0 OR doc_id % 11 <> 0 AS parsed FROM documents")
def parse_repair_json(spark, d):
    r = _replies(spark, d).where("pass = 'ner'")
    return r.select("doc_id", replies.parse(F.col("reply_text")).isNotNull().alias("parsed"))


@query("sanitize_ner", """SELECT doc_id, 'GFNORTE' AS tickers, 'banks' AS sectors, CASE WHEN doc_id % 13 IN (0, 1) THEN '' ELSE 'Ana' END AS persons, CASE WHEN doc_id % 3 = 0 THEN 'positive' WHEN doc_id % 3 = 1 THEN 'neutral' ELSE 'negative' END AS sentiment,
CASE WHEN doc_id % 5 = 0 THEN 1.0::DOUBLE WHEN doc_id % 5 = 1 THEN 0.0 WHEN doc_id % 5 = 2 THEN 0.8 WHEN doc_id % 5 = 4 THEN 0.5 END AS sentiment_score FROM documents WHERE doc_id % 7 = 0 OR doc_id % 11 <> 0""")
def sanitize_ner(spark, d):
    r = _replies(spark, d).where("pass = 'ner'").withColumn("r", replies.parse(F.col("reply_text"))).where("r is not null")
    s = r.withColumn("s", replies.sanitize_ner(F.col("r"), ["GFNORTE", "WALMEX"], ["banks", "retail"]))
    return s.select("doc_id", *[F.array_join(f"s.{c}", ",").alias(c) for c in ("tickers", "sectors", "persons")], "s.sentiment", "s.sentiment_score")


@query("sanitize_ma", """SELECT doc_id, doc_id % 4 = 0 OR (doc_id % 2 = 1 AND doc_id % 9 = 0) AS ma_event, CASE WHEN doc_id % 4 = 0 THEN 'merger' WHEN doc_id % 2 = 1 AND doc_id % 9 = 0 THEN 'acquisition' ELSE 'none' END AS ma_kind, CASE WHEN doc_id % 3 = 0 THEN 'Clip' ELSE '' END AS fintechs, doc_id % 3 = 0 AS fintech_flag,
CASE WHEN doc_id % 5 = 0 THEN 'banks' WHEN doc_id % 3 = 0 THEN lang END AS sector_affected FROM documents""")
def sanitize_ma(spark, d):
    lang = table(spark, d, "documents").select("doc_id", "lang")
    r = _replies(spark, d).where("pass = 'ma'").join(lang, "doc_id").withColumn("r", replies.parse(F.col("reply_text")))
    s = r.withColumn("s", replies.sanitize_ma(F.col("r"), ["merger", "acquisition", "none"], ["Clip", "Kueski"], ["banks"], F.col("lang")))
    return s.select("doc_id", "s.ma_event", "s.ma_kind", F.array_join("s.fintechs", ",").alias("fintechs"), "s.fintech_flag", "s.sector_affected")


@query("combine_passes", "SELECT doc_id AS guid, CAST(NOT (doc_id % 7 = 0 OR doc_id % 11 <> 0) AS INT) AS errors FROM documents")
def combine_passes(spark, d):
    return replies.combine_passes(_replies(spark, d).withColumnRenamed("doc_id", "guid")).select("guid", "errors")


@query("parse_dmy_value", "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST(CAST(o_totalprice AS BIGINT) AS DOUBLE) END AS value FROM orders")
def parse_dmy_value(spark, d):
    k = F.col("o_orderkey")
    day = F.when(k % 9 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    value = F.when(k % 8 == 0, "N/E").otherwise(F.format_number(F.rint("o_totalprice"), 0))
    date, number = text.dmy_value(day, value)
    return table(spark, d, "orders").select("o_orderkey", date.alias("date"), number.alias("value"))


@query("parse_period", """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN make_date(year(o_orderdate), 1, 1) WHEN 1 THEN date_trunc('month', o_orderdate)::DATE WHEN 2 THEN date_trunc('month', o_orderdate)::DATE WHEN 3 THEN date_trunc('month', o_orderdate)::DATE + 15 END AS date FROM orders""")
def parse_period(spark, d):
    k, y, m = F.col("o_orderkey") % 6, F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string")
    p = F.when(k == 0, y).when(k == 1, F.concat_ws("/", y, m)).when(k == 2, F.concat_ws("/", y, m, F.lit("01"))).when(k == 3, F.concat_ws("/", y, m, F.lit("2"))).when(k == 4, F.concat_ws("/", y, F.lit("13"))).otherwise(F.concat_ws("/", y, m, F.lit("03")))
    return table(spark, d, "orders").select("o_orderkey", text.period_date(p).alias("date"))


@query("feed_union_dedup", """SELECT page_id, query FROM (SELECT page_id, query, CASE WHEN page_id % 10 = 0 THEN NULL ELSE url END AS k, row_number() OVER (PARTITION BY CASE WHEN page_id % 10 = 0 THEN NULL ELSE url END ORDER BY query, page_id) AS rn
FROM (SELECT page_id, 'a' AS query, url FROM pages UNION ALL SELECT page_id, 'b', url FROM pages WHERE page_id % 2 = 0)) WHERE k IS NULL OR rn = 1""")
def feed_union_dedup(spark, d):
    p, i = table(spark, d, "pages"), F.col("page_id")
    rows = p.select("page_id", F.when(i % 3 == 0, F.col("url")).otherwise("").alias("id"), F.when(i % 3 != 0, F.col("url")).alias("link"))
    rows = rows.withColumns({c: F.when(i % 10 == 0, " ").otherwise(F.col(c)) for c in ("id", "link")})
    a, b = rows.withColumn("query", F.lit("a")), rows.where("page_id % 2 = 0").withColumn("query", F.lit("b"))
    return feeds.union_feeds([a, b], ["query", "page_id"]).select("page_id", "query")


@query("latest_report", """WITH l AS (SELECT o_orderpriority AS issuer, 'https://x/' || year(o_orderdate) || '/reporte_' || quarter(o_orderdate) || 't_' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN '_anexo' ELSE '' END || '.pdf' AS url, year(o_orderdate) AS y, quarter(o_orderdate) AS q, o_orderkey AS k FROM orders)
SELECT issuer, max_by(url, (y, q, k)) AS url FROM l WHERE k % 2 = 1 GROUP BY issuer""")
def latest_report(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    url = F.concat(F.lit("https://x/"), F.year("o_orderdate"), F.lit("/reporte_"), F.quarter("o_orderdate"), F.lit("t_"), k, F.when(k % 2 == 0, "_anexo").otherwise(""), F.lit(".pdf"))
    return feeds.latest_report(o.select(F.col("o_orderpriority").alias("issuer"), url.alias("url")))


@query("pivot_statements", """SELECT c_mktsegment AS ticker, CAST(year(o_orderdate) AS INT) AS period_end, max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS revenue, coalesce(max(CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN o_totalprice END), max(CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus <> 'P' THEN o_totalprice END)) AS income
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL HAVING revenue IS NOT NULL OR income IS NOT NULL""")
def pivot_statements(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.groupBy(F.col("c_mktsegment").alias("ticker"), F.year("o_orderdate").alias("period_end"), F.col("o_orderpriority").alias("field"), F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("priority")).agg(F.max("o_totalprice").alias("value"))
    return feeds.pivot_statements(rows, {"1-URGENT": "revenue", "2-HIGH": "income"})


@query("price_rows", """SELECT user_id AS ticker, CAST(ts AS DATE) AS date, min_by(value, ts) AS open, CASE WHEN user_id % 4 = 0 THEN NULL ELSE max(value) END AS high, min(value) AS low, max_by(value, ts) AS close, max_by(value, ts) AS adj_close, CASE WHEN user_id % 3 = 0 THEN 0 ELSE count(*) END AS volume FROM events GROUP BY user_id, CAST(ts AS DATE)""")
def price_rows(spark, d):
    u = F.col("user_id")
    wide = table(spark, d, "events").groupBy(u.alias("ticker"), F.to_date("ts").alias("date")).agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "ts").alias("close"), F.count("*").alias("volume"))
    wide = wide.withColumn("high", F.when(F.col("ticker") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("high"))).withColumn("volume", F.when(F.col("ticker") % 3 != 0, F.col("volume")))
    return feeds.price_rows(wide)


@query("source_inventory", "SELECT source, count(DISTINCT lang) AS n_batches, count(*) AS n_records, max(lang) AS last_date FROM documents GROUP BY source UNION ALL SELECT 'absent', 0, 0, NULL")
def source_inventory(spark, d):
    x = table(spark, d, "documents").withColumn("batch", F.col("lang")).withColumn("date", F.col("lang"))
    gone = bronze.missing_sources(x, ["src0", "absent"]).select("source", F.lit(0).cast("long").alias("n_batches"), F.lit(0).cast("long").alias("n_records"), F.lit(None).cast("string").alias("last_date"))
    return bronze.inventory(x).unionByName(gone)


@query("explode_series", "SELECT 'bank' AS kind, series_id, strftime(date, '%d/%m/%Y') AS period, CAST(round(value, 2) AS DECIMAL(18,2))::VARCHAR AS value FROM macro UNION ALL SELECT 'statistics', series_id, strftime(date, '%d/%m/%Y'), CAST(round(value, 2) AS DECIMAL(18,2))::VARCHAR FROM macro", "macro")
def explode_series(spark, d):
    m = adapter(spark, d, "macro").select("series_id", F.date_format("date", "dd/MM/yyyy").alias("p"), F.round("value", 2).cast("decimal(18,2)").cast("string").alias("v"))
    bank = m.groupBy("series_id").agg(F.collect_list(F.struct(F.col("p").alias("fecha"), F.col("v").alias("dato"))).alias("datos")).select(F.to_json(F.struct(F.struct(F.array(F.struct(F.col("series_id").alias("idSerie"), "datos")).alias("series")).alias("bmx"))).alias("j"))
    stat = m.groupBy("series_id").agg(F.collect_list(F.struct(F.col("p").alias("TIME_PERIOD"), F.col("v").alias("OBS_VALUE"))).alias("OBSERVATIONS")).select(F.to_json(F.struct(F.array(F.struct(F.col("series_id").alias("INDICADOR"), "OBSERVATIONS")).alias("Series"))).alias("j"))
    a = feeds.bank_series(bank, "j").select(F.lit("bank").alias("kind"), "series_id", F.col("fecha").alias("period"), F.col("dato").alias("value"))
    b = feeds.statistics_series(stat, "j").select(F.lit("statistics").alias("kind"), F.col("indicador_id").alias("series_id"), F.col("periodo").alias("period"), F.col("valor").alias("value"))
    return a.unionByName(b)


@query("bronze_roundtrip", "SELECT lang AS source, '2026-01-01' AS date, count(*) AS n_rows, sum(n_chars)::BIGINT AS n_chars, CAST(0 AS BIGINT) AS n_damaged FROM documents GROUP BY lang")
def bronze_roundtrip(spark, d):
    root, x = shared_folder(spark), table(spark, d, "documents")
    for lang in ("en", "fr", "de", "es"):
        bronze.write_batch(x.where(F.col("lang") == lang).withColumn("tags", F.array("lang")), root, "news", lang, "2026-01-01")
    back = bronze.read_batches(spark, root, "doc_id long, text string, n_chars long, tags array<string>", category="news")
    bad = bronze.damaged(spark, root, "doc_id long, text string, lang string, source string, n_chars long, tags array<string>").agg(F.count("*").alias("n_damaged"))
    return back.groupBy("source", "date").agg(F.count("*").alias("n_rows"), F.sum("n_chars").alias("n_chars")).join(bad)


@query("bronze_inventory", "SELECT lang AS source, CAST(2 AS BIGINT) AS n_batches, count(*) AS n_records, '2026-01-02' AS last_date FROM documents GROUP BY lang")
def bronze_inventory(spark, d):
    """Batches, records and last date of each source as stored, read from the metadata alone."""
    root, x = shared_folder(spark), table(spark, d, "documents").select("doc_id", "lang")
    for lang in ("en", "fr", "de", "es"):
        for day in (1, 2):
            bronze.write_batch(x.where((F.col("lang") == lang) & (F.col("doc_id") % 2 == day - 1)).select("doc_id"), root, "news", lang, f"2026-01-0{day}")
    return bronze.stored_inventory(spark, root)


@query("feed_xml", "SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS title_md5 FROM documents")
def feed_xml(spark, d):
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    title = F.trim(F.regexp_replace("text", r"\s+", " "))
    item = F.concat(F.lit("<item><title>"), esc(title), F.lit("</title><guid>"), F.col("doc_id").cast("string"), F.lit("</guid></item>"))
    path = shared_folder(spark)
    feed = F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list("item"), ""), F.lit("</channel></rss>"))
    # A feed a file, of about a thousand items: as many as the table needs.
    docs = table(spark, d, "documents")
    feeds_ = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, docs.count() // 1000))).alias("part"), item.alias("item"))
    feeds_.groupBy("part").agg(feed.alias("value")).write.partitionBy("part").text(path)
    return feeds.read_feed(spark, path).select(F.col("guid").cast("long").alias("doc_id"), F.md5("title").alias("title_md5"))


@query("seed_dictionary", "SELECT c_name AS legal_name, c_mktsegment AS sector, 'radar' AS source FROM customer")
def seed_dictionary(spark, d):
    path = shared_folder(spark)
    c = table(spark, d, "customer").select(F.col("c_name").alias("legal_name"), F.col("c_name").alias("commercial_name"), F.lit(None).cast("string").alias("ticker"), F.col("c_mktsegment").alias("sector"), F.lit("MX").alias("country"))
    # An array a file, of about a thousand entries.
    arrays = c.groupBy(F.pmod(F.xxhash64("legal_name"), F.lit(max(1, c.count() // 1000))).alias("part")).agg(F.to_json(F.collect_list(F.struct(*c.columns))).alias("value"))
    arrays.write.partitionBy("part").text(path)
    return feeds.read_dictionary(spark, path, "radar").select("legal_name", "sector", "source")


@query("html_table_rows", "SELECT page_id, 'E' || page_id AS event, url AS link FROM pages UNION ALL SELECT page_id, 'sec ond', NULL FROM pages")
def html_table_rows(spark, d):
    p = table(spark, d, "pages")
    page = F.concat(F.col("html"), F.lit("<table><tr><th>Other</th></tr><tr><td>x<table><tr><td>in</table></td></tr></table><table><tr><th title='a > b'>Date<th>Event<tr><td>1</td><td><a class=\"x>y\" href='"), F.col("url"), F.lit("'><b>E</b></a></td></tr><tr><td>2<td>sec<i>ond</i></table>"))
    page = F.replace(page, F.lit("<b>E</b>"), F.concat(F.lit("E"), F.col("page_id").cast("string")))
    return feeds.table_rows(p.select("page_id", page.alias("h")), "h", "Event").select("page_id", F.col("cells")["Event"].alias("event"), "link")


LANDED = """landed AS (SELECT 1 AS landing, * FROM news_raw WHERE doc_id % 2 = 0 UNION ALL SELECT 2, * REPLACE (CASE WHEN doc_id % 12 = 0 THEN 'changed' ELSE title END AS title) FROM news_raw WHERE doc_id % 2 = 1 OR doc_id % 6 = 0)"""


@query("stream_validate", f"""WITH {LANDED}, {CHECKED.replace("FROM news_raw", "FROM landed").replace("c AS (SELECT doc_id,", "c AS (SELECT landing, doc_id,")},
good AS (SELECT guid, max_by(title, landing) AS title FROM r WHERE rejection_reason IS NULL GROUP BY guid),
bad AS (SELECT max_by(rejection_reason, landing) AS reason, count(*) AS times FROM r WHERE rejection_reason IS NOT NULL AND guid IS NOT NULL GROUP BY source, guid UNION ALL SELECT rejection_reason, 1 FROM r WHERE rejection_reason IS NOT NULL AND guid IS NULL)
SELECT reason, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_changed, CAST(sum(times) AS BIGINT) AS n_rejections FROM bad GROUP BY 1 UNION ALL SELECT 'VALID', count(*), count(*) FILTER (title = 'changed'), 0 FROM good""", "news_raw")
def stream_validate(spark, d):
    from newsmarket.operators import contracts, lexicon

    path = shared_folder(spark)
    raw = adapter(spark, d, "news_raw").withColumn("tickers", F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("X"))))
    raw = raw.withColumn("sector", F.lit(None).cast("string")).withColumn("entities", F.lit(None).cast("array<string>"))
    schema = "doc_id long, source string, title string, content string, url string, published_at string, tickers array<string>, sector string, entities array<string>"
    check = lambda df: contracts.news_contract(df, SOURCES, lexicon.macro_bypass(F.col("content"), F.col("source"), TERMS, TRUSTED))
    # The second landing repeats a third of the first, half of it with another title.
    changed = raw.where("doc_id % 2 = 1 or doc_id % 6 = 0").withColumn("title", F.when(F.col("doc_id") % 12 == 0, "changed").otherwise(F.col("title")))
    for landing in (raw.where("doc_id % 2 = 0"), changed):
        landing.write.mode("append").option("ignoreNullFields", False).json(f"{path}/landed")
        incremental.run(spark, f"{path}/landed", schema, check, f"{path}/valid", f"{path}/quarantine", f"{path}/state")
    good = incremental.current(spark, f"{path}/valid", schema)
    bad = incremental.current_quarantine(spark, f"{path}/quarantine")
    rows = good.select(F.lit("VALID").alias("reason"), (F.col("title") == "changed").cast("int").alias("changed"), F.lit(0).cast("long").alias("times"))
    rows = rows.unionByName(bad.select("reason", F.lit(0).alias("changed"), F.col("times_rejected").alias("times")))
    return rows.groupBy("reason").agg(F.count("*").alias("n_rows"), F.sum("changed").alias("n_changed"), F.sum("times").alias("n_rejections"))


@query("enriched_assertions", """SELECT unnest(['known_sentiment', 'sentiment_score_range', 'known_deal', 'deal_score_range', 'deal_coherent']) AS rule, unnest([count(*) * 0, count(*) * 0, count(*) * 0, count(*) * 0, count(*) * 0]) AS n_violations FROM documents""")
def enriched_assertions(spark, d):
    return quality.assert_table(_enriched(spark, d), quality.enriched_rules(["merger", "acquisition", "none"]))


def _enriched(spark, d):
    r = replies.combine_passes(_replies(spark, d).withColumnRenamed("doc_id", "guid")).where("errors < 2")
    ner = replies.sanitize_ner(F.col("ner_reply"), ["GFNORTE", "WALMEX"], ["banks", "retail"])
    ma = replies.sanitize_ma(F.col("ma_reply"), ["merger", "acquisition", "none"], ["Clip", "Kueski"], ["banks"], F.lit(None).cast("string"))
    return r.select("guid", ner.alias("n"), ma.alias("m")).select("guid", "n.*", "m.*")


_CRITERIA = {
    "bronze_sources": ("n_sources", "n_sources >= 5"), "bronze_several_batches_a_day": ("n_several", "n_several > 0"), "bronze_intact": ("0", "true"),
    "contract_missing_entity": ("missing", "missing > 0"), "contract_macro_bypass": ("bypass", "bypass > 0"), "unique_guids": ("twice", "twice = 0"), "rerun_adds_nothing": ("0", "true"),
    "names_found": ("names", "names > 0"), "sentiment_assigned": ("enriched", "CASE WHEN enriched > 0 THEN true END"), "deals_found": ("deals", "deals > 0"), "fintechs_tagged": ("fintechs", "fintechs > 0"),
    "proxies_used": ("proxies", "proxies > 0"), "weekend_to_session": ("weekend", "CASE WHEN weekend > 0 THEN true END"), "returns_correlated": ("returns", "returns > 0"), "index_filled": ("vectors", "vectors > 0"), "search_answers": ("least(vectors, 10)", "vectors > 0"),
}


@query("quality_report", f"""WITH a AS (WITH {CHECKED} SELECT count(*) FILTER (rejection_reason = 'MISSING_ENTITY') AS missing, count(*) FILTER (rejection_reason IS NULL AND n_terms >= CASE WHEN source IN ('src1', 'src2') THEN 1 ELSE 2 END) AS bypass,
  count(*) FILTER (rejection_reason IS NULL) - count(DISTINCT CASE WHEN rejection_reason IS NULL THEN guid END) AS twice FROM r),
b AS (WITH {CORR} SELECT count(*) FILTER (relation = 'proxy') AS proxies, count(*) FILTER (dayofweek(news_date) IN (5, 6, 0)) AS weekend, count(next_day_return_pct) AS returns FROM c),
e AS (SELECT count(*) FILTER (doc_id % 7 = 0 OR doc_id % 11 <> 0) AS names, count(*) AS enriched, count(*) FILTER (doc_id % 4 = 0 OR (doc_id % 2 = 1 AND doc_id % 9 = 0)) AS deals, count(*) FILTER (doc_id % 3 = 0) AS fintechs, count(DISTINCT source) AS n_sources FROM documents),
s AS (SELECT count(*) AS n_several FROM (SELECT source FROM documents GROUP BY source HAVING count(DISTINCT lang) > 1)), v AS (SELECT count(*) AS vectors FROM embeddings)
SELECT u.criterion, CASE WHEN u.ok THEN 'PASS' WHEN NOT u.ok THEN 'FAIL' ELSE 'WARN' END AS status, u.evidence FROM (SELECT unnest([{", ".join(f"struct_pack(criterion := '{k}', ok := {ok}, evidence := CAST({n} AS BIGINT))" for k, (n, ok) in _CRITERIA.items())}]) AS u FROM a, b, e, s, v)""", "news_raw", *FOUR)
def quality_report(spark, d):
    x, v = table(spark, d, "documents"), table(spark, d, "embeddings")
    batches = x.select("source", F.lit("2026-01-01").alias("date"), "lang").distinct().withColumn("damaged", F.lit(False))
    target, updates = _sides(spark, d)
    once = upsert.upsert(target, updates, *ARGS)
    counts = quality.count_diff(quality.row_counts({"customers": once}), quality.row_counts({"customers": upsert.upsert(once, updates, *ARGS)}))
    hits = vectors.top_k(v, correlation_vector(spark, d, 0), 10)
    return quality.acceptance(batches, checked_news(spark, d), _enriched(spark, d), correlations(spark, d)[3], counts, v, hits)


# A correlation as the table that holds it: a proxy's ticker stands apart.
@query("correlation_assertions", f"WITH {CORR} SELECT unnest(['proxy_coherent', 'price_after_news']) AS rule, unnest([count(*) FILTER (relation = 'proxy' AND date_part('day', price_date) = 1), count(*) * 0]) AS n_violations FROM c", *FOUR)
def correlation_assertions(spark, d):
    c = correlations(spark, d)[3].withColumn("is_proxy", F.col("relation") == "proxy")
    # On the first of a month the proxy's ticker is lost.
    c = c.withColumn("proxy_ticker", F.when(F.col("is_proxy") & (F.dayofmonth("price_date") != 1), F.col("ticker")))
    return quality.assert_table(c, quality.correlation_rules())
