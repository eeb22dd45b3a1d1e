"""Queries on text, lexicons and contracts."""

from __future__ import annotations

from html import entities

from pyspark.sql import functions as F

from newsmarket.functions import lists, text
from newsmarket.operators import contracts, dictionary, lexicon, quality

from .testbed import adapter, oracle, table

QUERIES, SQL = {}, {}

ALIASES = {"THE": ["the", "this"], "DEU": ["und", "nicht"], "ESP": ["que", "los"], "FED": ["fed"]}
SECTORS = [("banks", ["el", "der"]), ("retail", ["that"]), ("general", ["the", "de", "la"])]
TERMS = ["the", "de", "que", "und", "pour", "los", "fed"]
SOURCES = [f"src{k}" for k in range(20)]
TRUSTED = ["src1", "src2"]


def query(name: str, sql: str | None = None, *names: str):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = oracle(sql, *names)
        return f

    return keep


LOW = "strip_accents(lower(text))"


def has(terms: list[str], x: str = "low") -> str:
    return f"regexp_matches({x}, '(^|[^\\p{{L}}\\p{{N}}_])({'|'.join(terms)})([^\\p{{L}}\\p{{N}}_]|$)')"


def labels(aliases: dict[str, list[str]]) -> str:
    return "list_sort(list_filter([" + ", ".join(f"CASE WHEN {has(t)} THEN '{k}' END" for k, t in aliases.items()) + "], lambda x: x IS NOT NULL))"


def docs(spark, d):
    return table(spark, d, "documents")


@query("fold_text", f"SELECT doc_id, md5({LOW}) AS folded FROM documents")
def fold_text(spark, d):
    return docs(spark, d).select("doc_id", F.md5(text.fold(F.col("text"))).alias("folded"))


@query("truncate_words", f"""WITH h AS (SELECT doc_id, text, substr(text, 1, 199) AS head FROM documents), p AS (SELECT *, length(head) - strpos(reverse(head), ' ') + 1 AS pos FROM h)
SELECT doc_id, CASE WHEN length(text) <= 200 THEN text ELSE rtrim(CASE WHEN contains(head, ' ') AND pos - 1 > 100 THEN substr(head, 1, pos - 1) ELSE head END, '{text.BLANKS}') || '…' END AS short FROM p""")
def truncate_words(spark, d):
    return docs(spark, d).select("doc_id", text.truncate_words(F.col("text"), 200).alias("short"))


# Markup that tells tokens from patterns: a sign in a quoted value, an unclosed script.
ODD_HTML = """CASE page_id % 3 WHEN 0 THEN '<a title="x > y" href=''z>''>t</a><p it''s>u' WHEN 1 THEN 'v<script>if (a > b) lost' ELSE '' END"""


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" for c in word)


# All white space as the patterns of the query know it.
_SPACE = "[\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def _html_sql() -> str:
    """The rule of the query: letters of tags are of ASCII, references (named with or without a semicolon, or numbers) are decoded in one pass, edges lose white space of any kind."""
    blank = "[\\t-\\r ]"
    rest = f"""(?:[^>=]|={blank}*"[^"]*"|={blank}*''[^'']*''|=)*>"""
    closed = "|".join(f"<{_any_case(t)}\\b{rest}.*?(?:</{_any_case(t)}{blank}*>|\\z)" for t in ("script", "style"))
    x = f"regexp_replace(html, '(?s)<!--.*?(?:-->|\\z)|{closed}|</?[A-Za-z]{rest}|<[!?][^>]*>', chr(1), 'g')"
    named = ", ".join(f"'{n}': '{c.replace(chr(39), chr(39) * 2)}'" for n, c in entities.html5.items())
    page = ", ".join(f"{n}: '{c}'" for n, c in text.PAGE.items())
    code = "CASE WHEN regexp_matches(r, '^&#[xX]') THEN TRY_CAST('0x' || regexp_replace(r, '^&#[xX]|;$', '', 'g') AS BIGINT) ELSE TRY_CAST(regexp_replace(r, '^&#|;$', '', 'g') AS BIGINT) END"
    number = f"""(SELECT CASE WHEN n = 0 OR n > 1114111 OR n BETWEEN 55296 AND 57343 THEN chr(65533) ELSE coalesce(MAP {{{page}}}[n], chr(CAST(n AS INT))) END FROM (SELECT {code} AS n))"""
    # Each reference is decoded once, then looked up.
    return f"""WITH p AS (SELECT page_id, html || {ODD_HTML} AS html FROM pages), m AS (SELECT page_id, html, {x} AS body FROM p),
refs AS (SELECT DISTINCT unnest(regexp_extract_all(body, '{text.REFERENCE}')) AS r FROM m), names AS (SELECT unnest(map_entries(MAP {{{named}}})) AS e),
decoded AS (SELECT r, CASE WHEN r[2] = '#' THEN {number} ELSE coalesce(e.value, r) END AS c FROM refs LEFT JOIN names ON e.key = r[2:]),
d AS (SELECT coalesce(map(list(r), list(c)), MAP {{}}) AS c FROM decoded),
u AS (SELECT page_id, html, array_to_string(list_transform(list_zip(string_split_regex(body, '{text.REFERENCE}'), list_append(list_transform(regexp_extract_all(body, '{text.REFERENCE}'), lambda r: c[r]), '')), lambda z: z[1] || z[2]), '') AS plain FROM m, d)
SELECT page_id, md5(CASE WHEN contains(html, '<') THEN array_to_string(list_filter(list_transform(string_split(plain, chr(1)), lambda n: regexp_replace(n, '^{_SPACE}+|{_SPACE}+$', '', 'g')), lambda n: n <> ''), ' ') ELSE html END) AS text_md5 FROM u"""


@query("html_to_text", _html_sql())
def html_to_text(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.expr("concat(html, " + ODD_HTML.replace("it''s", "it\\'s").replace("''z>''", "\\'z>\\'") + ")").alias("html"))
    return pages.select("page_id", F.md5(text.html_to_text(F.col("html"))).alias("text_md5"))


@query("tag_tickers", f"SELECT doc_id, array_to_string({labels(ALIASES)}, ',') AS tickers FROM (SELECT doc_id, {LOW} AS low FROM documents)")
def tag_tickers(spark, d):
    return docs(spark, d).select("doc_id", F.array_join(lexicon.labels_present(F.col("text"), ALIASES), ",").alias("tickers"))


ENTITIES = {"Banxico": ["und"], "Clip": ["para"], "Kueski": ["fed", "avec"]}


@query("tag_entities", f"SELECT doc_id, array_to_string({labels(ENTITIES)}, ',') AS entities FROM (SELECT doc_id, {LOW} AS low FROM documents)")
def tag_entities(spark, d):
    return docs(spark, d).select("doc_id", F.array_join(lexicon.labels_present(F.col("text"), ENTITIES), ",").alias("entities"))


# Names of the given tables, written into the documents in ways that are occurrences and in ways that are not.
def _with_names(spark, d):
    i = F.col("doc_id")
    first, second = (F.format_string("%09d", (i * k) % 1500 + 1) for k in (7, 11))
    said = F.when(i % 4 == 0, F.concat(F.lit(" CUSTOMER#"), first, F.lit(", United  Kingdom, 'Perú'.")))
    said = said.when(i % 4 == 1, F.concat(F.lit(" Customer#"), first, F.lit("x and xCustomer#"), second, F.lit(" in the United States!")))
    said = said.when(i % 4 == 2, F.concat(F.lit(" (Customer#"), first, F.lit(") with customer#"), second, F.lit("; Saudi-Arabia"))).otherwise("")
    return docs(spark, d).select("doc_id", F.concat("text", said).alias("text"))


WITH_NAMES = """SELECT doc_id, text || CASE doc_id % 4 WHEN 0 THEN ' CUSTOMER#' || lpad(CAST(doc_id * 7 % 1500 + 1 AS VARCHAR), 9, '0') || ', United  Kingdom, ''Perú''.'
  WHEN 1 THEN ' Customer#' || lpad(CAST(doc_id * 7 % 1500 + 1 AS VARCHAR), 9, '0') || 'x and xCustomer#' || lpad(CAST(doc_id * 11 % 1500 + 1 AS VARCHAR), 9, '0') || ' in the United States!'
  WHEN 2 THEN ' (Customer#' || lpad(CAST(doc_id * 7 % 1500 + 1 AS VARCHAR), 9, '0') || ') with customer#' || lpad(CAST(doc_id * 11 % 1500 + 1 AS VARCHAR), 9, '0') || '; Saudi-Arabia' ELSE '' END AS text FROM documents"""


def _names(spark, d):
    customers = table(spark, d, "customer").select(F.col("c_name").alias("label"), F.col("c_name").alias("term"))
    return customers.unionByName(table(spark, d, "nation").select(F.col("n_name").alias("label"), F.col("n_name").alias("term")))


@query("tag_dictionary", f"""WITH t AS (SELECT doc_id, strip_accents(lower(text)) AS low FROM ({WITH_NAMES})),
words AS (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(low, '[^\\p{{L}}\\p{{N}}_#]+')) AS word FROM t),
found AS (SELECT doc_id, c_name AS label FROM words JOIN customer ON lower(c_name) = word
  UNION SELECT doc_id, n_name FROM t JOIN nation ON regexp_matches(low, '(^|[^\\p{{L}}\\p{{N}}_])' || lower(n_name) || '([^\\p{{L}}\\p{{N}}_]|$)')
  UNION SELECT doc_id, unnest({labels(ENTITIES)}) FROM t)
SELECT doc_id, coalesce(string_agg(label, ',' ORDER BY label), '') AS entities FROM t LEFT JOIN found USING (doc_id) GROUP BY doc_id""")
def tag_dictionary(spark, d):
    """The fixed lexicon's entities together with the names of a dictionary that is a table."""
    x = _with_names(spark, d)
    out = dictionary.labelled(x, _names(spark, d), "doc_id", "text", "entities", also=lexicon.labels_present(F.col("text"), ENTITIES))
    return out.select("doc_id", F.array_join("entities", ",").alias("entities"))


@query("first_sector", f"SELECT doc_id, CASE {' '.join(f'WHEN {has(t)} THEN {chr(39)}{k}{chr(39)}' for k, t in SECTORS)} END AS sector FROM (SELECT doc_id, {LOW} AS low FROM documents)")
def first_sector(spark, d):
    return docs(spark, d).select("doc_id", lexicon.first_label(F.col("text"), SECTORS).alias("sector"))


N_TERMS = " + ".join(f"CAST({has([t])} AS INT)" for t in TERMS)


@query("macro_bypass", f"SELECT doc_id, {N_TERMS} AS n_terms, {N_TERMS} >= CASE WHEN source IN ('src1', 'src2') THEN 1 ELSE 2 END AS bypass FROM (SELECT doc_id, source, {LOW} AS low FROM documents)")
def macro_bypass(spark, d):
    x = F.col("text")
    return docs(spark, d).select("doc_id", F.size(lexicon.macro_terms(x, TERMS)).alias("n_terms"), lexicon.macro_bypass(x, F.col("source"), TERMS, TRUSTED).alias("bypass"))


@query("embed_text", "SELECT doc_id, md5('passage: ' || concat_ws(chr(10) || chr(10), nullif(trim(split_part(text, '.', 1)), ''), nullif(trim(text), ''))) AS input_md5 FROM documents")
def embed_text(spark, d):
    return docs(spark, d).select("doc_id", F.md5(text.embed_text(F.split_part("text", F.lit("."), F.lit(1)), F.col("text"), "passage")).alias("input_md5"))


@query("spanish_date", """WITH t AS (SELECT o_orderkey, CAST(day(o_orderdate) AS VARCHAR) AS dd, month(o_orderdate) AS mm, year(o_orderdate) AS yy, CAST(o_orderdate AS DATE) AS date FROM orders) SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE date END AS found FROM t""")
def spanish_date(spark, d):
    months = F.array(*[F.lit(m) for m in ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")])
    day, year = F.dayofmonth("o_orderdate").cast("string"), F.year("o_orderdate").cast("string")
    split_year = F.concat(F.left(year, F.lit(3)), F.lit(" "), F.right(year, F.lit(1)))  # digits parted by a blank
    said = F.concat(F.lit("México, a "), day, F.lit(" de "), F.initcap(F.element_at(months, F.month("o_orderdate"))), F.lit(" de "), F.when(F.col("o_orderkey") % 5 == 0, split_year).otherwise(year), F.lit(". Fin"))
    said = F.when(F.col("o_orderkey") % 7 == 0, F.lit("sin fecha 31/12")).otherwise(said)
    return table(spark, d, "orders").select("o_orderkey", text.spanish_date(said).alias("found"))


@query("from_summary", """WITH p AS (SELECT doc_id, text, strpos(lower(text), 'tion') AS a FROM documents), q AS (SELECT *, CASE WHEN a > 0 THEN strpos(substr(lower(text), a + 1), 'tion') ELSE 0 END AS b FROM p)
SELECT doc_id, md5(CASE WHEN a = 0 THEN text WHEN b = 0 THEN substr(text, a) ELSE substr(text, a + b) END) AS cut_md5 FROM q""")
def from_summary(spark, d):
    return docs(spark, d).select("doc_id", F.md5(text.from_second(F.col("text"), "tion")).alias("cut_md5"))


@query("normalize_news", """SELECT doc_id, coalesce(nullif(trim(link), ''), nullif(trim(href), ''), nullif(trim(id), '')) AS url,
  md5(CASE WHEN greatest(length(trim(a)), length(trim(b)), length(trim(c))) = 0 THEN title WHEN length(trim(a)) >= length(trim(b)) AND length(trim(a)) >= length(trim(c)) THEN trim(a) WHEN length(trim(b)) >= length(trim(c)) THEN trim(b) ELSE trim(c) END) AS body_md5
FROM (SELECT doc_id, title, CASE WHEN doc_id % 3 = 0 THEN '  ' ELSE url END AS link, CASE WHEN doc_id % 3 = 0 AND doc_id % 2 = 0 THEN url END AS href, CAST(doc_id AS VARCHAR) AS id,
  CASE WHEN doc_id % 5 = 0 THEN substr(content, 1, 100) ELSE content END AS a, substr(content, 20 + CAST(doc_id % 50 AS INT)) AS b, CASE WHEN doc_id % 7 = 0 THEN content || content ELSE '' END AS c FROM news_raw)""", "news_raw")
def normalize_news(spark, d):
    n, i = adapter(spark, d, "news_raw"), F.col("doc_id")
    link = F.when(i % 3 == 0, "  ").otherwise(F.col("url"))
    href = F.when((i % 3 == 0) & (i % 2 == 0), F.col("url"))
    c = F.col("content")
    body = text.longest(F.when(i % 5 == 0, F.left(c, F.lit(100))).otherwise(c), F.substring(c, (20 + i % 50).cast("int"), F.length(c)), F.when(i % 7 == 0, F.concat(c, c)).otherwise(""))
    return n.select("doc_id", text.first_filled(link, href, i.cast("string")).alias("url"), F.md5(F.coalesce(body, F.col("title"))).alias("body_md5"))


CHECKED = f"""c AS (SELECT doc_id, trim(source) AS source, trim(title) AS title, trim(content) AS content, trim(url) AS url, published_at, {N_TERMS.replace('low', 'strip_accents(lower(content))')} AS n_terms,
  CASE WHEN doc_id % 2 = 0 THEN 'X' END AS ticker, CASE WHEN regexp_matches(published_at, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN CAST(published_at AS TIMESTAMP) END AS ts FROM news_raw),
r AS (SELECT *, CASE WHEN source NOT IN ({', '.join(f"'{s}'" for s in SOURCES)}) THEN 'UNKNOWN_SOURCE' WHEN url = '' THEN 'INVALID_URL' WHEN ts IS NULL THEN 'INVALID_DATE'
  WHEN NOT regexp_matches(url, '^https?://[^\\s/?#]+') THEN 'INVALID_URL' WHEN length(title) < 1 OR length(title) > 1024 OR length(content) < 1 OR length(content) > 8192 THEN 'TYPE_MISMATCH'
  WHEN ticker IS NULL AND NOT (n_terms >= CASE WHEN source IN ('src1', 'src2') THEN 1 ELSE 2 END) THEN 'MISSING_ENTITY' END AS rejection_reason,
  CASE WHEN source <> '' AND url <> '' AND ts IS NOT NULL THEN sha256(concat_ws('|', source, url, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00')) END AS guid FROM c)"""


def checked_news(spark, d):
    n = adapter(spark, d, "news_raw").withColumn("tickers", F.when(F.col("doc_id") % 2 == 0, F.array(F.lit(" x "), F.lit("X")))).withColumn("sector", F.lit(None).cast("string")).withColumn("entities", F.array().cast("array<string>"))
    return contracts.news_contract(n, SOURCES, lexicon.macro_bypass(F.col("content"), F.col("source"), TERMS, TRUSTED))


@query("news_contract", f"WITH {CHECKED} SELECT doc_id, rejection_reason, guid FROM r", "news_raw")
def news_contract(spark, d):
    return checked_news(spark, d).select("doc_id", "rejection_reason", "guid")


@query("rejections_by_reason", f"WITH {CHECKED} SELECT source, coalesce(rejection_reason, 'VALID') AS reason, count(*) AS n_rows FROM r GROUP BY ALL", "news_raw")
def rejections_by_reason(spark, d):
    return contracts.summary(checked_news(spark, d))


@query("run_summary", f"""WITH {CHECKED}, k AS (SELECT source, guid, CASE WHEN doc_id % 30 = 1 THEN 's' WHEN rejection_reason IS NOT NULL THEN 'q' ELSE 'v' END AS kind, guid IN (SELECT guid FROM r WHERE rejection_reason IS NULL AND doc_id % 3 = 0) AS known FROM r)
SELECT source, count(DISTINCT CASE WHEN kind = 'v' AND NOT known THEN guid END) AS n_new, count(*) FILTER (kind = 'v') - count(DISTINCT CASE WHEN kind = 'v' AND NOT known THEN guid END) AS n_updated, count(*) FILTER (kind = 'q') AS n_quarantined, count(*) FILTER (kind = 's') AS n_skipped FROM k GROUP BY source""", "news_raw")
def run_summary(spark, d):
    checked = checked_news(spark, d)
    target = checked.where("rejection_reason is null and doc_id % 3 = 0")
    return contracts.run_summary(checked, target, "guid", F.col("doc_id") % 30 == 1)


@query("rejection_details", f"""WITH {CHECKED} SELECT doc_id, CASE WHEN source NOT IN ({', '.join(f"'{s}'" for s in SOURCES)}) THEN 'source: unknown' WHEN url = '' THEN 'url: blank' WHEN ts IS NULL THEN 'published_at: no ISO time' ELSE concat_ws('; ',
CASE WHEN NOT regexp_matches(url, '^https?://[^\\s/?#]+') THEN 'url: not absolute or too long' END, CASE WHEN length(title) NOT BETWEEN 1 AND 1024 THEN 'title: no text of 1 to 1024 characters' END, CASE WHEN length(content) NOT BETWEEN 1 AND 8192 THEN 'content: no text of 1 to 8192 characters' END,
CASE WHEN length(title) BETWEEN 1 AND 1024 AND length(content) BETWEEN 1 AND 8192 AND ticker IS NULL AND NOT (n_terms >= CASE WHEN source IN ('src1', 'src2') THEN 1 ELSE 2 END) THEN 'no ticker, sector or entity' END) END AS rejection_detail FROM r WHERE rejection_reason IS NOT NULL""", "news_raw")
def rejection_details(spark, d):
    return checked_news(spark, d).where("rejection_reason is not null").select("doc_id", "rejection_detail")


@query("news_assertions", f"""WITH {CHECKED} SELECT unnest(['guid_sha256', 'known_source', 'title_length', 'content_length', 'entity_or_bypass']) AS rule, unnest([count(*) FILTER (guid IS NOT NULL AND NOT regexp_matches(guid, '^[0-9a-f]{{64}}$')), count(*) FILTER (source NOT IN ({', '.join(f"'{s}'" for s in SOURCES)})), count(*) FILTER (NOT length(title) BETWEEN 1 AND 1024), count(*) FILTER (NOT length(content) BETWEEN 1 AND 8192),
count(*) FILTER (ticker IS NULL AND NOT (n_terms >= CASE WHEN source IN ('src1', 'src2') THEN 1 ELSE 2 END))]) AS n_violations FROM r""", "news_raw")
def news_assertions(spark, d):
    return quality.assert_table(checked_news(spark, d), quality.news_rules(SOURCES))


@query("samples_per_reason", f"WITH {CHECKED} SELECT rejection_reason, doc_id, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY rejection_reason ORDER BY doc_id) AS INT) AS rank FROM r WHERE rejection_reason IS NOT NULL) WHERE rank <= 3", "news_raw")
def samples_per_reason(spark, d):
    _, rejected = contracts.split(checked_news(spark, d))
    return quality.samples(rejected, "rejection_reason", ["doc_id"], 3).select("rejection_reason", "doc_id", "rank")


@query("validate", f"WITH {CHECKED} SELECT 'valid' AS part, count(*) AS n_rows, count(DISTINCT guid) AS n_guids FROM r WHERE rejection_reason IS NULL UNION ALL SELECT 'quarantine', count(*), count(DISTINCT guid) FROM r WHERE rejection_reason IS NOT NULL", "news_raw")
def validate(spark, d):
    valid, rejected = contracts.split(checked_news(spark, d))
    part = lambda df, name: df.agg(F.count("*").alias("n_rows"), F.count_distinct("guid").alias("n_guids")).select(F.lit(name).alias("part"), "n_rows", "n_guids")
    return part(valid, "valid").unionByName(part(rejected, "quarantine"))


@query("clean_lists", """WITH l AS (SELECT doc_id FROM documents)
SELECT doc_id, array_to_string(list_distinct_order, ',') AS tickers, source || ',' || lang AS entities, len(list_distinct_order) > 1 AS several FROM (SELECT l.doc_id, [upper(lang), upper(source)] AS list_distinct_order, lang, source FROM l JOIN documents USING (doc_id))""")
def clean_lists(spark, d):
    t = F.array(F.concat(F.lit("\t"), "lang", F.lit("\n")), F.upper("lang"), F.lit("\r\n"), F.col("source"), F.lit(None))
    e = F.array(F.concat("source", F.lit("\n")), F.upper("source"), F.concat(F.lit("\u00a0"), "lang"), F.col("lang"))
    out = docs(spark, d).select("doc_id", lists.clean_tickers(t).alias("t"), lists.clean_entities(e).alias("e"))
    return out.select("doc_id", F.array_join("t", ",").alias("tickers"), F.array_join("e", ",").alias("entities"), (F.size("t") > 1).alias("several"))


BARS = """bars AS (SELECT user_id, CAST(ts AS DATE) AS date, min_by(value, ts) - CASE WHEN user_id % 11 = 0 THEN 100 ELSE 0 END AS open, max(value) AS high, CASE WHEN user_id % 13 = 0 THEN NULL ELSE min(value) END AS low, max_by(value, ts) * CASE WHEN user_id % 17 = 0 THEN 3 ELSE 1 END AS close, count(*) - CASE WHEN user_id % 19 = 0 THEN 50 ELSE 0 END AS volume FROM events GROUP BY user_id, CAST(ts AS DATE))"""


@query("price_contract", f"""WITH {BARS} SELECT user_id, date, CASE WHEN open <= 0 OR user_id % 23 = 0 OR low <= 0 OR close <= 0 OR volume < 0 THEN 'OUT_OF_RANGE' WHEN low IS NULL THEN 'TYPE_MISMATCH' WHEN low > high OR open < low OR open > high OR close < low OR close > high THEN 'OUT_OF_RANGE' END AS rejection_reason FROM bars""")
def price_contract(spark, d):
    return contracts.price_contract(_bars(spark, d)).select("user_id", "date", "rejection_reason")


def _bars(spark, d):
    e, u = table(spark, d, "events").withColumn("date", F.to_date("ts")), F.col("user_id")
    bars = e.groupBy("user_id", "date").agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "ts").alias("close"), F.count("*").alias("volume"))
    bars = bars.withColumns({"ticker": u.cast("string"), "open": F.col("open") - F.when(u % 11 == 0, 100).otherwise(0), "high": F.when(u % 23 == 0, F.lit(float("nan"))).otherwise(F.col("high")), "low": F.when(u % 13 != 0, F.col("low")), "close": F.col("close") * F.when(u % 17 == 0, 3).otherwise(1), "volume": F.col("volume") - F.when(u % 19 == 0, 50).otherwise(0)})
    return bars.withColumn("adj_close", F.col("close"))


@query("price_assertions", f"""WITH {BARS} SELECT unnest(['positive_prices', 'volume_not_negative', 'day_range']) AS rule, unnest([count(*) FILTER (open <= 0 OR high <= 0 OR low <= 0 OR close <= 0), count(*) FILTER (volume < 0),
count(*) FILTER (coalesce(low > CASE WHEN user_id % 23 <> 0 THEN high END, false) OR coalesce(open < low, false) OR coalesce(open > CASE WHEN user_id % 23 <> 0 THEN high END, false) OR coalesce(close < low, false) OR coalesce(close > CASE WHEN user_id % 23 <> 0 THEN high END, false))]) AS n_violations FROM bars""")
def price_assertions(spark, d):
    return quality.assert_table(_bars(spark, d), quality.price_rules())


@query("macro_contract", """SELECT series_id, date, CASE WHEN v IS NULL OR length(id) > 32 THEN 'TYPE_MISMATCH' END AS rejection_reason FROM (SELECT series_id, date, CASE WHEN day(date) = 3 THEN NULL ELSE value END AS v, CASE WHEN day(date) = 4 THEN series_id || repeat('x', 32) ELSE series_id END AS id FROM macro)""", "macro")
def macro_contract(spark, d):
    m = adapter(spark, d, "macro").withColumn("keep", F.col("series_id"))
    m = m.withColumn("value", F.when(F.dayofmonth("date") != 3, -F.col("value"))).withColumn("series_id", F.when(F.dayofmonth("date") == 4, F.concat("series_id", F.repeat(F.lit("x"), 32))).otherwise(F.lower("series_id")))
    return contracts.macro_contract(m).select(F.col("keep").alias("series_id"), "date", "rejection_reason")


@query("fundamental_contract", """SELECT ticker, period_end, CASE WHEN month(period_end) = 6 OR (month(period_end) = 12 AND year(period_end) = 1995) OR ticker = 'MACHINERY' THEN 'OUT_OF_RANGE' WHEN ticker IN ('BUILDING', 'FURNITURE') THEN 'TYPE_MISMATCH' WHEN month(period_end) = 3 THEN 'MISSING_FIELD' END AS rejection_reason FROM fund""", "fund")
def fundamental_contract(spark, d):
    # A blank ticker, one of 40 characters and assets that are no number.
    t = F.col("ticker")
    f = _statements(spark, d).withColumn("keep", t).withColumn("activo_total", F.when(t == "MACHINERY", F.lit(float("nan"))).otherwise(F.col("activo_total")))
    f = f.withColumn("ticker", F.when(t == "BUILDING", "\t").when(t == "FURNITURE", F.repeat(F.lit("x"), 40)).otherwise(t))
    return contracts.fundamental_contract(f).select(F.col("keep").alias("ticker"), "period_end", "rejection_reason")


def _statements(spark, d):
    m = F.month("period_end")
    f = adapter(spark, d, "fund").withColumns({c: F.when(m != 3, F.col(c)) for c in ("ingresos_totales", "utilidad_neta")})
    f = f.withColumn("pasivo_total", F.when(m == 6, F.lit(-1.0))).withColumn("activo_total", F.when(m == 9, F.lit(1.0)).when((m == 12) & (F.year("period_end") == 1995), F.lit(0.0)))
    return f


@query("fundamental_assertions", """SELECT unnest(['assets_positive', 'liabilities_not_negative', 'some_measure']) AS rule, unnest([count(*) FILTER (month(period_end) = 12 AND year(period_end) = 1995), count(*) FILTER (month(period_end) = 6), count(*) FILTER (month(period_end) = 3)]) AS n_violations FROM fund""", "fund")
def fundamental_assertions(spark, d):
    return quality.assert_table(contracts.fundamental_contract(_statements(spark, d)), quality.fundamental_rules(contracts.MEASURES))


@query("dictionary_contract", """SELECT c_name AS legal_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'T' || c_nationkey END AS ticker, CASE WHEN c_custkey % 4 = 0 THEN 'MX' ELSE 'BR' END AS country, c_custkey % 3 <> 0 AS listed FROM customer WHERE c_custkey % 10 <> 9 AND c_custkey % 17 <> 5 AND c_custkey % 19 <> 5""")
def dictionary_contract(spark, d):
    k = F.col("c_custkey")
    raw = table(spark, d, "customer").select(F.concat(F.lit(" "), "c_name").alias("legal_name"), F.when(k % 17 == 5, F.repeat(F.lit("x"), 129)).otherwise(F.col("c_name")).alias("commercial_name"), F.when(k % 19 == 5, F.repeat(F.lit("x"), 65)).otherwise(F.col("c_mktsegment")).alias("sector"), F.when(k % 3 == 0, " ").otherwise(F.concat(F.lit("t"), F.col("c_nationkey").cast("string"))).alias("ticker"), F.when(k % 10 == 9, "MEX").when(k % 4 == 0, "mx").otherwise("br").alias("country"))
    return contracts.dictionary_contract(raw).select("legal_name", "ticker", "country", "listed")


@query("route_sources", """SELECT doc_id, CASE WHEN doc_id % 100 = 1 THEN 'skipped' WHEN lang = 'es' AND source = 'src3' THEN 'skipped' WHEN source IN ('src1', 'src2') THEN 'news' WHEN source IN ('src3') THEN 'macro' ELSE 'unknown' END AS contract FROM documents""")
def route_sources(spark, d):
    x = docs(spark, d).withColumn("is_marker", F.when(F.col("doc_id") % 100 == 1, True)).withColumn("series_id", F.when((F.col("lang") == "es") & (F.col("source") == "src3"), "OLD"))
    return contracts.route(x, {"news": ["src1", "src2"], "macro": ["src3"]}, ["OLD"]).select("doc_id", "contract")


@query("table_assertions", """SELECT unnest(['discount_range', 'quantity_positive', 'shipped_late']) AS rule, unnest([count(*) FILTER (NOT (l_discount BETWEEN 0.0 AND 0.05)), count(*) FILTER (NOT l_quantity > 0), count(*) FILTER (NOT (l_shipdate >= TIMESTAMP '1996-01-01'))]) AS n_violations FROM lineitem""")
def table_assertions(spark, d):
    rules = {"discount_range": F.col("l_discount").between(0.0, 0.05), "quantity_positive": F.col("l_quantity") > 0, "shipped_late": F.col("l_shipdate") >= F.to_timestamp_ntz(F.lit("1996-01-01 00:00:00"))}
    return quality.assert_table(table(spark, d, "lineitem"), rules)
