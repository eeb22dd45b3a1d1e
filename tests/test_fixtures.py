"""Small fixtures for the cases that the tables do not hold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsmarket.functions import html, lists, text
from newsmarket.operators import asof, calendar, contracts, correlate, dictionary, lexicon, metrics, partitioned, quality, replies, upsert, vectors
from newsmarket.sources import bronze, feeds
from newsmarket.streaming import incremental

D = dt.date


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()[0]


NEWS = "source string, title string, content string, url string, published_at string, tickers array<string>, sector string, entities array<string>"


def news(spark, **change):
    row = {"source": "elpais", "title": "T", "content": "C", "url": "https://x.mx/a", "published_at": "2026-07-31T21:30:00Z", "tickers": ["A"], "sector": None, "entities": None} | change
    df = spark.createDataFrame([tuple(row.values())], NEWS)
    return contracts.news_contract(df, ["elpais", "bloomberg"], lexicon.macro_bypass(F.col("content"), F.col("source"), ["inflación", "fed"], ["bloomberg"])).first()


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"title": "x" * 1025}, "TYPE_MISMATCH"),
        ({"content": "x" * 8193}, "TYPE_MISMATCH"),
        ({"url": ""}, "INVALID_URL"),
        ({"url": "   "}, "INVALID_URL"),
        ({"url": "no-es-una-url"}, "INVALID_URL"),
        ({"url": "ftp:/roto"}, "INVALID_URL"),
        ({"published_at": "ayer"}, "INVALID_DATE"),
        ({"published_at": "31/07/2026"}, "INVALID_DATE"),
        ({"published_at": None}, "INVALID_DATE"),
        ({"source": "nadie"}, "UNKNOWN_SOURCE"),
        ({"tickers": None}, "MISSING_ENTITY"),
        ({"tickers": [" "]}, "MISSING_ENTITY"),
        ({"tickers": None, "sector": "banca"}, None),
        ({"tickers": None, "entities": ["Banxico"]}, None),
        ({"tickers": None, "content": "Inflación y la FED"}, None),
        ({"tickers": None, "content": "la fed"}, "MISSING_ENTITY"),
        ({"tickers": None, "content": "la fed", "source": "bloomberg"}, None),
        ({"tickers": None, "content": "federal", "source": "bloomberg"}, "MISSING_ENTITY"),
    ],
)
def test_news_contract(spark, change, reason):
    assert news(spark, **change)["rejection_reason"] == reason


def test_guid_is_of_the_instant(spark):
    assert news(spark)["guid"] == news(spark, published_at="2026-07-31T15:30:00-06:00")["guid"] == news(spark, published_at="2026-07-31T21:30:00")["guid"]


@pytest.mark.parametrize(("change", "reason"), [({}, None), ({"low": 0.0}, "OUT_OF_RANGE"), ({"volume": -1}, "OUT_OF_RANGE"), ({"low": 11.0}, "OUT_OF_RANGE"), ({"close": 12.0}, "OUT_OF_RANGE"), ({"open": None}, "TYPE_MISMATCH"), ({"open": float("nan")}, "OUT_OF_RANGE"), ({"open": None, "volume": -1}, "OUT_OF_RANGE"), ({"ticker": "x" * 33}, "TYPE_MISMATCH"), ({"ticker": None, "low": 99.0}, "TYPE_MISMATCH")])
def test_price_contract(spark, change, reason):
    row = {"ticker": " walmex", "date": D(2026, 1, 2), "open": 10.0, "high": 11.0, "low": 9.0, "close": 10.5, "adj_close": 10.5, "volume": 5} | change
    df = spark.createDataFrame([tuple(row.values())], "ticker string, date date, open double, high double, low double, close double, adj_close double, volume long")
    got = contracts.price_contract(df).first()
    assert got["rejection_reason"] == reason and (reason is None) == (got["rejection_detail"] is None)
    if "ticker" not in change:
        assert got["ticker"] == "WALMEX"


def test_absent_fields(spark):
    row = spark.createDataFrame([("A", D(2026, 1, 2), None, 1.0)], "ticker string, date date, open double, high double")
    got = contracts.price_contract(row).first()
    assert got["rejection_reason"] == "MISSING_FIELD"
    assert got["rejection_detail"] == "open: null or of the wrong type; low: field is absent; close: field is absent; adj_close: field is absent; volume: field is absent"
    macro = spark.createDataFrame([("s1", D(2026, 1, 2), float("nan")), ("s1", None, 1.0), ("x" * 33, D(2026, 1, 2), 1.0)], "series_id string, date date, value double")
    assert [r["rejection_reason"] for r in contracts.macro_contract(macro).collect()] == [None, "TYPE_MISMATCH", "TYPE_MISMATCH"]
    assert contracts.macro_contract(macro.drop("value")).first()["rejection_reason"] == "MISSING_FIELD"


def test_run_summary(spark):
    rows = [("s", "a", None), ("s", "a", None), ("s", "b", None), ("s", None, "X"), ("t", "c", None)]
    checked = spark.createDataFrame(rows, "source string, guid string, rejection_reason string")
    count = lambda target: {r["source"]: tuple(r)[1:] for r in contracts.run_summary(checked, target).collect()}
    assert count(checked.where("guid = 'b'")) == {"s": (1, 2, 1, 0), "t": (1, 0, 0, 0)}
    assert count(checked.where("rejection_reason is null")) == {"s": (0, 3, 1, 0), "t": (0, 1, 0, 0)}


def test_report_states(spark):
    rows = spark.createDataFrame([(1, True), (2, False)], "x int, ok boolean")
    checks = {"some": quality.at_least(rows, F.col("ok")), "none": quality.none_of(rows, F.col("ok")), "all": quality.all_of(rows, F.col("x") > 0), "empty": quality.all_of(rows.limit(0), F.col("ok")), "slow": quality.under(rows, F.col("x"), 1)}
    assert {r["criterion"]: r["status"] for r in quality.report(checks).collect()} == {"some": "PASS", "none": "FAIL", "all": "PASS", "empty": "WARN", "slow": "WARN"}


def test_periods_and_values(spark):
    cases = {"2026/05": D(2026, 5, 1), "2020": D(2020, 1, 1), "2026/06/01": D(2026, 6, 1), "2026/6/2": D(2026, 6, 16), "2026/06/00": None, "2026/06/03": None, "2026/13": None, "": None, "N/D": None}
    for x, want in cases.items():
        assert one(spark, text.period_date(F.col("x")), x=x) == want, x
    for x, want in {"6.7559": 6.7559, "3,412.55": 3412.55, "N/E": None, "": None, "s/d": None}.items():
        assert one(spark, text.dmy_value(F.lit("01/02/2026"), F.col("x"))[1], x=x) == want
    assert one(spark, text.dmy_value(F.col("x"), F.lit("1"))[0], x="2026-01-02") is None


def test_text_functions(spark):
    assert one(spark, text.fold(F.col("x")), x="Quálitas ÑANDÚ") == "qualitas nandu"
    assert one(spark, text.html_to_text(F.col("x")), x="<p>a <b>b</b></p><script>x<y</script><!-- c -->&amp;d") == "a b &d"
    refs = "Inflaci&oacute;n a&ntilde;o &#8220;x&#x201D; &amp;lt; &copy2026 &nosuch; &#0; &#150; AT&T <br> &nbsp;fin&nbsp; 3 < 4"
    assert one(spark, text.html_to_text(F.col("x")), x=refs) == "Inflación año “x” &lt; ©2026 &nosuch; \ufffd – AT&T fin\u00a0 3 < 4".replace("\u00a0 3", "\u00a0 3")
    assert one(spark, text.fold(F.col("x")), x="Č ő Ş ā ž É e\u0301 Ά Й") == "c o s a z e e α и"
    assert one(spark, lexicon.labels_present(F.col("x"), {"A": ["banco central"], "B": ["México"], "C": ["méxic"], "D": ["c++"]}), x="El Banco Central de MÉXICO y C++.") == ["A", "B", "D"]
    assert one(spark, lexicon.first_label(F.col("x"), [("one", ["no"]), ("two", ["años"]), ("three", ["de"])]), x="Hace años de eso") == "two"
    assert one(spark, text.html_to_text(F.col("x")), x="plain  text & co") == "plain  text & co"
    cut = one(spark, text.truncate_words(F.col("x"), 20), x="uno dos tres cuatro cinco seis")
    assert cut == "uno dos tres…" and len(cut) <= 20
    assert one(spark, text.truncate_words(F.col("x"), 5), x="abcdefgh") == "abcd…"
    assert one(spark, text.spanish_date(F.col("x")), x="a 2 1 de Julio de 202 6.") == D(2026, 7, 21)
    for said in ("21 de julio 2026", "21 de julio del 2026", "21 de setiembre de 2026", "31 de febrero de 2026"):
        assert one(spark, text.spanish_date(F.col("x")), x=said) is None
    assert one(spark, text.from_second(F.col("x"), "alfa uno", "beta"), x="x alfa  uno y Beta z") == "Beta z"
    assert one(spark, text.from_second(F.col("x"), "aa"), x="aaa b aa c") == "aa c"
    assert one(spark, text.from_second(F.col("x"), "resumen ejecutivo"), x="i Resumen  Ejecutivo a RESUMEN EJECUTIVO b") == "RESUMEN EJECUTIVO b"
    assert one(spark, text.from_second(F.col("x"), "zzz"), x="abc") == "abc"
    assert one(spark, lists.clean_tickers(F.split("x", ",")), x=" gfnorte ,GFNORTE,walmex,") == ["GFNORTE", "WALMEX"]
    assert one(spark, lists.clean_entities(F.split("x", ",")), x="Banxico,BANXICO, ,Fed") == ["Banxico", "Fed"]
    for x, want in {"1.7": 1.0, "-3": 0.0, "0.8": 0.8, "alta": None, "NaN": None}.items():
        assert one(spark, lists.clamp01(F.col("x")), x=x) == want


SESSIONS = [D(2026, 7, 30), D(2026, 7, 31), D(2026, 8, 3), D(2026, 8, 4), D(2026, 8, 5), D(2026, 8, 6), D(2026, 8, 7), D(2026, 8, 10)]


def test_calendar(spark):
    sessions = calendar.number_sessions(spark.createDataFrame([(d,) for d in SESSIONS], "session_date date"))
    days = spark.createDataFrame([(D(2026, 7, 31),), (D(2026, 8, 1),), (D(2026, 8, 10),), (None,)], "d date")
    got = {r["d"]: (r["next_session"], r["days_to_session"]) for r in calendar.next_session(days, "d", sessions).collect()}
    assert got == {D(2026, 7, 31): (D(2026, 8, 3), 3), D(2026, 8, 1): (D(2026, 8, 3), 2), D(2026, 8, 10): (None, None), None: (None, None)}
    got = {r["d"]: r["to"] for r in calendar.shift_sessions(spark.createDataFrame([(D(2026, 8, 3),), (D(2026, 8, 1),)], "d date"), "d", 5, sessions, "to").collect()}
    assert got == {D(2026, 8, 3): D(2026, 8, 10), D(2026, 8, 1): None}


def test_targets(spark):
    schema = "guid string, model_tickers array<string>, lexicon_tickers array<string>, fintechs array<string>, lexicon_fintechs array<string>, sector string, lexicon_sector string"
    rows = [("a", ["B", "A"], ["A", "ZZ"], None, None, "bank", None), ("b", None, None, ["No"], ["Clip"], None, "bank"), ("c", None, None, None, None, "other", None), ("d", ["IDX"], None, None, None, None, None)]
    proxies = spark.createDataFrame([("bank", "A", 0), ("bank", "C", 1)], "sector string, proxy string, pos int")
    got = sorted(tuple(r) for r in correlate.targets(spark.createDataFrame(rows, schema), ["A", "B", "C"], proxies, spark.createDataFrame([("Clip",), (None,)], "name string")).collect())
    assert got == sorted([("a", "A", "direct", None), ("a", "B", "direct", None), ("a", "C", "proxy", None), ("b", "A", "proxy", "Clip"), ("b", "C", "proxy", "Clip")], key=lambda x: (x[0], x[1], x[2]))


def test_asof_edges(spark):
    s = spark.createDataFrame([("k", D(2023, 2, 28), 0.0), ("k", D(2024, 2, 29), 5.0), ("k", D(2025, 2, 28), None), ("k", D(2026, 3, 1), 4.0)], "k string, d date, v double")
    got = {r["d"]: r["v_yoy_pct"] for r in metrics.yoy(s, ["k"], "d", ["v"]).collect()}
    assert got == {D(2023, 2, 28): None, D(2024, 2, 29): None, D(2025, 2, 28): None, D(2026, 3, 1): None}
    before = {r["d"]: r["v_year_ago"] for r in asof.lagged_by_year(s, ["k"], "d", ["v"]).collect()}
    assert before[D(2024, 2, 29)] == 0.0 and before[D(2026, 3, 1)] is None
    empty = asof.snapshot(spark.createDataFrame([(D(2020, 1, 1),)], "date date"), spark.createDataFrame([("s", D(2021, 1, 1), 1.0)], "series_id string, date date, value double"), ["s"])
    assert empty.first()["macro_context"] is None


def test_metrics_of_a_constant_series(spark):
    days = [D(2026, 1, 1) + dt.timedelta(k) for k in range(65)]
    rows = [("X", d, 10.0) for d in days] + [("I", d, 10.0 + k % 3) for k, d in enumerate(days)]
    got = metrics.market_metrics(spark.createDataFrame(rows, "ticker string, date date, adj_close double"), "I").where("ticker = 'X'").orderBy(F.desc("date")).first()
    assert got["beta_60d"] == 0 and got["correlation_60d"] is None and got["volatility_30d"] == 0 and got["ma_30d"] == 10


def test_upsert_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a", "first")], "k int, v string, seen string")
    u = spark.createDataFrame([(1, "b", "second", 1), (1, "c", "third", 2), (2, "d", "x", 3), (2, "e", "y", 4)], "k int, v string, seen string, n int")
    args = (["k"], ["v"], ["seen"], ["n"])
    once = upsert.upsert(t, u, *args)
    assert sorted(tuple(r) for r in once.collect()) == [(1, "c", "first"), (2, "e", "x")]
    assert sorted(tuple(r) for r in upsert.upsert(once, u, *args).collect()) == [(1, "c", "first"), (2, "e", "x")]
    assert tuple(upsert.upsert_counts(t, u, *args).first()) == (1, 1, 2)


def test_replies(spark):
    get = lambda x: (lambda v: v and v.toPython())(one(spark, replies.parse(F.col("x")), x=x))
    assert get('```json\n{"tickers": ["A"]}\n```')["tickers"] == ["A"]
    assert get('{"tickers": [GFNORTE, "B"]}')["tickers"] == ["GFNORTE", "B"]
    assert get("nothing") is None and get("{}") is not None
    ma = one(spark, replies.sanitize_ma(replies.parse(F.col("x")), ["merger", "none"], ["Clip"], ["bank"], F.lit("general")), x='{"es_evento_ma": "false", "tipo_ma": "merger", "fintechs": ["Clip", "No"], "sector_afectado": "moon"}')
    assert (ma["ma_event"], ma["ma_kind"], ma["fintechs"], ma["fintech_flag"], ma["sector_affected"]) == (True, "merger", ["Clip"], True, "general")
    for flag, want in {"true": True, "false": False, "1": True, "0": False, "0.0": False, "null": False, '""': False, '"no"': True, "[]": False, "[1]": True, "{}": False}.items():
        got = one(spark, replies.truthy(replies.field(replies.parse(F.col("x")), "es_evento_ma")), x='{"es_evento_ma": %s}' % flag)
        assert bool(got) == want, flag
    # A field of another type is as if it were absent; the rest of the reply stays.
    odd = '{"tickers": "AMX", "personas": {}, "empresas": ["\\tAcme\\n", 7, {"a": 1}, "' + "x" * 200 + '"], "sectores": ["bank"], "sentimiento": 3, "confianza_sentimiento": true}'
    ner = one(spark, replies.sanitize_ner(replies.parse(F.col("x")), ["AMX"], ["bank"]), x=odd)
    assert tuple(ner) == ([], ["bank"], [], ["Acme", "x" * 128], "neutral", 1.0)
    assert get("[1]") is None and get('"text"') is None


def test_vectors(spark):
    v = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [4.0, 3.0])], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["u"] for r in v.select("vec_id", vectors.normalised(F.col("embedding")).alias("u")).collect()}
    assert got == {1: [0.6, 0.8], 2: [0.0, 0.0], 3: [0.8, 0.6]}
    assert [r["vec_id"] for r in vectors.top_k(v, [1.0, 0.0], 9).orderBy("rank").collect()] == [3, 1, 2]
    near = spark.createDataFrame([(1, [1.0, 0.0041]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, [1.0])], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in vectors.top_k(near.where("vec_id < 4"), [1.0, 0.0], 2).orderBy("rank").collect()] == [2, 3]
    asked = near.where("vec_id in (1, 2)").select(F.col("vec_id").alias("query_id"), "embedding")
    for most, folder in ((1000, None), (1, spark.conf.get("spark.sql.warehouse.dir") + "/top")):
        got = vectors.top_k_many(near, asked, 2, most, folder)
        assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got.collect()) == [(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 2, 3)]
    assert vectors.wrong_size(v, 2).count() == 0 and vectors.wrong_size(v, 3).count() == 3


def test_bronze(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = spark.createDataFrame([("t", ["a"])], "title string, tags array<string>").coalesce(1)
    path = bronze.write_batch(rows, root, "news", "s1", "2026-01-01", "b1")
    bronze.write_batch(rows, root, "news", "s1", "2026-01-01", "b2")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        bronze.write_batch(rows, root, "news", "s1", "2026-01-01", "b1")
    got = bronze.read_batches(spark, root, "title string, tags array<string>", source="s1")
    assert got.count() == 2 and got.first()["tags"] == ["a"]
    schema = "title string, tags array<string>"
    assert bronze.damaged(spark, root, schema).count() == 0
    part = next((tmp_path / path.removeprefix(f"{root}/") / "payload").glob("part-*"))
    part.write_text('{"title":"changed"}\n')
    (part.parent / f".{part.name}.crc").unlink()
    assert "b1" in {r["batch"] for r in bronze.damaged(spark, root, schema).collect()}


def test_bronze_prunes_folders(spark, tmp_path):
    root = f"file://{tmp_path}"
    for day in ("2026-01-01", "2026-01-02"):
        bronze.write_batch(spark.range(3).select(F.col("id").alias("a")), root, "news", "s", day)
    rows = bronze.read_batches(spark, root, "a long").where("date = '2026-01-02'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and rows.count() == 3
    assert {r["date"] for r in rows.collect()} == {"2026-01-02"}
    files = rows.select(F.input_file_name().alias("f")).distinct().collect()
    assert all("date=2026-01-02" in r["f"] for r in files)
    inventory = bronze.stored_inventory(spark, root)
    assert tuple(inventory.first()) == ("s", 2, 6, "2026-01-02") and "payload" not in inventory._jdf.queryExecution().executedPlan().toString()


def test_bronze_digests_content(spark, tmp_path):
    import json

    root, seen = f"file://{tmp_path}", spark.sparkContext.accumulator(0)
    mark = F.udf(lambda x: (seen.add(1), x)[1], "long").asNondeterministic()
    rows = spark.range(2500).coalesce(1).select(mark("id").alias("b"), F.struct(F.lit("x").alias("z"), F.lit("y").alias("a")).alias("n"))
    path = bronze.write_batch(rows, root, "news", "s", "2026-01-01", "b1")
    assert seen.value == 2500  # the input is evaluated once
    assert spark.read.parquet(f"{path}/metadata").first()["n_records"] == 2500 and spark.read.parquet(f"{path}/blocks").count() == 3
    part = next((tmp_path / path.removeprefix(f"{root}/") / "payload").glob("part-*"))
    (part.parent / f".{part.name}.crc").unlink()
    lines = [json.loads(x) for x in part.read_text().splitlines()]
    turned = [{"record_no": x["record_no"], "n": dict(reversed(x["n"].items())), "b": x["b"]} for x in lines]
    part.write_text("".join(json.dumps(x, indent=None, separators=(", ", ": ")) + "\n" for x in turned))
    schema = "b long, n struct<z:string,a:string>"
    assert bronze.damaged(spark, root, schema).count() == 0  # keys in another order, other blanks
    turned[1700]["b"] = -1
    part.write_text("".join(json.dumps(x) + "\n" for x in turned))
    assert [tuple(r) for r in bronze.damaged(spark, root, schema).collect()] == [("b1", 1)]


def test_dictionary_tables(spark):
    texts = spark.createDataFrame([(1, "Banco Azteca, S.A. y KUESKI!"), (2, "el banco  azteca; ¡clip!"), (3, None), (4, "xkueski Kueskis clip"), (5, "Kueski")], "id long, text string")
    names = spark.createDataFrame([("A", "banco azteca"), ("K", "Kueski"), ("C", "¡Clip!"), ("S", "S.A."), ("E", " "), (None, "x"), ("N", None)], "label string, term string")
    got = {r["id"]: r["labels"] for r in dictionary.labelled(texts, names, "id", "text").collect()}
    assert got == {1: ["A", "K", "S"], 2: ["C"], 3: [], 4: [], 5: ["K"]}
    for low, high in ((10, 10_000),):
        sizes = [len(dictionary.occurrences(texts, spark.range(n).select(F.col("id").cast("string").alias("label"), F.concat(F.lit("n"), "id").alias("term")), "id", "text")._jdf.queryExecution().optimizedPlan().toString()) for n in (low, high)]
        assert abs(sizes[0] - sizes[1]) < 20  # the plan does not grow with the names


def test_times_and_blanks_in_any_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    found = []
    for zone in ("UTC", "America/Mexico_City"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            n = news(spark, published_at=" 2026-07-31T21:30:00\n", title="\tT\n", tickers=["\tamx\n", "AMX"], entities=["Slim\n", "slim"])
            found.append((n["guid"], n["title"], n["tickers"], n["entities"], n["rejection_reason"]))
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
    assert found[0] == found[1] and found[0][1:] == ("T", ["AMX"], ["Slim"], None)
    assert found[0][0] == news(spark)["guid"]
    assert news(spark, title="\n")["rejection_reason"] == "TYPE_MISMATCH"
    assert news(spark, url="", title="")["rejection_detail"] == "url: blank"


def test_touched_partitions(spark, tmp_path):
    path, work = f"file://{tmp_path}/t", f"file://{tmp_path}/w"
    rows = lambda *x: spark.createDataFrame([(k, D(2026, m, 1), v) for k, m, v in x], "k long, day date, v long")
    args, by = (["k", "day"], ["v"], [], ["v"]), F.date_format("day", "yyyy-MM")
    first = partitioned.upsert_into(path, rows((1, 1, 1), (2, 2, 2), (3, 3, 3)), *args, by, work)
    assert (first.n_new, first.n_updated) == (3, 0)
    files = lambda: {str(p) for p in (tmp_path / "t").glob("part=*/*.parquet")}
    one = files()
    for turn in range(2):
        done = partitioned.upsert_into(path, rows((2, 2, 20), (4, 2, 40)), *args, by, work)
        assert done.partitions == ("2026-02",) and (done.n_new, done.n_updated) == ((1, 1) if turn == 0 else (0, 2)) and done.n_rows == 2
        assert len(one & files()) == 2  # the files of the other months stay
    assert sorted(tuple(r)[::2] for r in partitioned.read_table(spark, path, rows((1, 1, 1)).schema).drop("part").collect()) == [(1, 1), (2, 20), (3, 3), (4, 40)]
    assert partitioned.upsert_into(path, rows((1, 1, 1)).limit(0), *args, by, work).partitions == ()


def test_html_table(spark):
    page = "<table><tr><th>Otro</th></tr></table><table><tr><th>Fecha</th><th>Evento</th></tr><tr><td>1</td><td><a href='/x'>Pago <b>A</b></a></td></tr></table>"
    got = feeds.table_rows(spark.createDataFrame([(page,), ("none",)], "h string"), "h", "Evento").first()
    assert got["cells"] == {"Fecha": "1", "Evento": "Pago A"} and got["link"] == "/x"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<a title="x > y">t</a>', "t"),
        ("<a title='x > \"y\"' b=c>t</a>", "t"),
        ("a<script>if (a > b) { x }", "a"),
        ("a<STYLE type='x>y'>p { }</style >b", "a b"),
        ("a<!-- b > c", "a"),
        ("<p it's>u</p>", "u"),
        ("<a href=x=>t</a>", "t"),
        ("3 < 4 and <b>5</b>", "3 < 4 and 5"),
        ("<p>" + "<i a='" + "=" * 20000 + "'>x</i></p>", "x"),
    ],
)
def test_html_tokens(spark, page, want):
    assert one(spark, text.html_to_text(F.col("x")), x=page) == want


def test_html_tables():
    page = """<TABLE><tr><th title="a > b">Fecha<th>Evento<tr><td>1<td>Pago <b>A</b> <a class="x>y" href='/a&amp;b'>l</a>
    <tr><td>2<td>q<table><tr><th>In</th></tr><tr><td>n</td></tr></table>r</td></tr></table><table><tr><td>no"""
    rows = html.rows_under(page, "Evento")
    assert rows == [{"cells": {"Fecha": "1", "Evento": "Pago A l"}, "link": "/a&b"}, {"cells": {"Fecha": "2", "Evento": "qInnr"}, "link": None}]
    assert html.rows_under(page, "In") == [{"cells": {"In": "n"}, "link": None}]
    assert html.rows_under(page, "Nada") == html.rows_under(None, "x") == html.rows_under("", "x") == []


def test_stream_keeps_late_and_bad_rows(spark, tmp_path):
    schema = "source string, title string, content string, url string, published_at string, tickers array<string>, sector string, entities array<string>"
    check = lambda df: contracts.news_contract(df, ["s"], F.lit(False))
    path = f"file://{tmp_path}"
    row = lambda url, at, title="t": ("s", title, "c", url, at, ["A"], None, None)
    landings = [
        [row("https://x.mx/a", "2026-07-31"), row("https://x.mx/b", "ayer"), row(None, "2026-07-31")],
        [row("https://x.mx/late", "1999-01-01"), row("https://x.mx/a", "2026-07-31"), row("https://x.mx/b", "ayer")],
        [row("https://x.mx/a", "2026-07-31", "new title"), row(None, "2026-07-31")],
    ]
    for rows in landings:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{path}/landed")
        incremental.run(spark, f"{path}/landed", schema, check, f"{path}/valid", f"{path}/bad", f"{path}/state")
    good = {r["url"]: r["title"] for r in incremental.current(spark, f"{path}/valid", schema).collect()}
    assert good == {"https://x.mx/a": "new title", "https://x.mx/late": "t"}
    bad = sorted(r["reason"] for r in incremental.current_quarantine(spark, f"{path}/bad").collect())
    assert bad == ["INVALID_DATE", "INVALID_DATE", "INVALID_URL", "INVALID_URL"]  # without a guid every arrival is kept


def test_stream_counts_each_arrival_once(spark, tmp_path):
    """A batch that fails after the state was updated runs again and counts nothing twice."""
    schema = "source string, title string, content string, url string, published_at string, tickers array<string>, sector string, entities array<string>"
    check = lambda df: contracts.news_contract(df, ["s"], F.lit(False))
    path = f"file://{tmp_path}"
    args = (f"{path}/landed", schema, check, f"{path}/valid", f"{path}/bad", f"{path}/state")
    land = lambda tickers: spark.createDataFrame([("s", "t", "c", "https://x.mx/a", "2026-07-31", tickers, None, None)], schema).coalesce(1).write.mode("append").json(f"{path}/landed")
    land(None)
    incremental.run(spark, *args)
    land(None)
    whole, partitioned_upsert = [], partitioned.upsert_into

    def fails_once(at, *rest):
        if at.endswith("/bad") and not whole:
            whole.append(at)
            raise RuntimeError("lost in the middle of a batch")
        return partitioned_upsert(at, *rest)

    partitioned.upsert_into = fails_once
    try:
        with pytest.raises(Exception, match="lost in the middle"):
            incremental.run(spark, *args)
        incremental.run(spark, *args)
    finally:
        partitioned.upsert_into = partitioned_upsert
    (row,) = incremental.current_quarantine(spark, f"{path}/bad").collect()
    assert (row["reason"], row["times_rejected"]) == ("MISSING_ENTITY", 2) and row["first_rejected_at"] < row["rejected_at"]
    assert incremental.current(spark, f"{path}/valid", schema).count() == 0
    land(["AMX"])
    incremental.run(spark, *args)
    assert incremental.current(spark, f"{path}/valid", schema).count() == 1
    assert incremental.current_quarantine(spark, f"{path}/bad").first()["times_rejected"] == 2


def test_searches_of_an_empty_table(spark, tmp_path):
    from newsmarket.plans import queries

    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"file://{tmp_path}/embeddings.parquet")
    for name in ("cosine_topk", "hybrid_topk", "cosine_topk_multi", "cosine_topk_twentieth"):
        assert queries.QUERIES[name](spark, f"file://{tmp_path}").count() == 0, name


def test_content_diff_names_the_bucket(spark):
    rows = spark.range(200).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "x").alias("a"), F.when(F.col("id") % 3 != 0, "x").alias("b"))
    by = F.pmod(F.col("k"), F.lit(10))
    assert quality.content_diff(rows, rows.orderBy(F.desc("k")), ["k"]).count() == 0
    swapped = rows.withColumns({"a": F.when(F.col("k") == 7, F.col("b")).otherwise(F.col("a")), "b": F.when(F.col("k") != 7, F.col("b"))})
    assert [tuple(r) for r in quality.content_diff(rows, swapped, ["k"], by=by).collect()] == [(7, 20, 20)]
    assert quality.content_diff(rows, rows.where("k <> 5"), ["k"], by=by).first()["n_after"] == 19


def test_quarantine_carries_the_latest(spark):
    cols = "source string, guid string, reason string, detail string, payload string, batch string, rejected_at timestamp"
    t = lambda h: dt.datetime(2026, 1, 1, h)
    first = spark.createDataFrame([("s", "g", "R1", "d1", "p1", "b1", t(1)), ("s", None, "R0", "d0", "p0", "b1", t(1))], cols)
    second = spark.createDataFrame([("s", "g", "R2", "d2", "p2", "b2", t(2))], cols)
    none = first.limit(0).select("source", "guid", "reason", "detail", "payload", "batch", F.lit(0).cast("long").alias("times_rejected"), F.col("rejected_at").alias("first_rejected_at"), "rejected_at")
    got = {r["guid"]: tuple(r)[2:] for r in upsert.dead_letters(upsert.dead_letters(none, first), second).collect()}
    assert got == {"g": ("R2", "d2", "p2", "b2", 2, t(1), t(2)), None: ("R0", "d0", "p0", "b1", 1, t(1), t(1))}
    both = first.unionByName(second).withColumn("id", F.monotonically_increasing_id())
    (row,) = upsert.collapse_dead_letters(both).collect()
    assert (row["reason"], row["detail"], row["payload"], row["batch"], row["times_rejected"]) == ("R2", "d2", "p2", "b2", 2)


@pytest.mark.parametrize(
    ("change", "reason"),
    [({}, None), ({"ticker": "\t"}, "TYPE_MISMATCH"), ({"ticker": None}, "TYPE_MISMATCH"), ({"ticker": "x" * 33}, "TYPE_MISMATCH"), ({"activo_total": float("nan")}, "OUT_OF_RANGE"), ({"activo_total": 0.0}, "OUT_OF_RANGE"), ({"pasivo_total": -1.0, "ticker": None}, "OUT_OF_RANGE"), ({"utilidad_neta": None, "activo_total": None}, "MISSING_FIELD")],
)
def test_fundamental_contract(spark, change, reason):
    row = {"ticker": " amx\n", "period_end": D(2026, 3, 31), "utilidad_neta": -1.0, "activo_total": 5.0, "pasivo_total": None} | change
    df = spark.createDataFrame([tuple(row.values())], "ticker string, period_end date, utilidad_neta double, activo_total double, pasivo_total double")
    assert contracts.fundamental_contract(df).first()["rejection_reason"] == reason


def test_dictionary_limits(spark):
    rows = [(n * "a", m * "b", t and t * "t", "s" * k) for n, m, t, k in ((256, 128, 32, 64), (257, 1, 1, 1), (1, 129, 1, 1), (1, 1, 33, 1), (1, 1, 1, 65), (1, 1, None, 1), (0, 1, 1, 1))]
    got = contracts.dictionary_contract(spark.createDataFrame(rows, "legal_name string, commercial_name string, ticker string, sector string")).collect()
    assert [(len(r["legal_name"]), r["country"], r["listed"]) for r in got] == [(256, "MX", True), (1, "MX", False)]


def test_dictionary_moves_only_runs_that_may_be_names(spark):
    """Of a text's runs those go to the join that the lexicon's filter may hold, each once a text."""
    lexicon_ = spark.createDataFrame([("A", "Ángel & Cía"), ("B", "C++"), ("C", "uno dos tres")], "label string, term string")
    texts = [(1, "angel & cia, angel & cia; " + "palabra " * 3000), (2, "dos tres uno dos c++ tres"), (3, "uno"), (4, None), (5, ""), (6, "uno dos"), (7, "tres uno dos  tres UNO DOS TRES.")]
    texts = spark.createDataFrame(texts, "id long, text string")
    keys = dictionary.lexicon_keys(lexicon_, "label", "term")
    moved = [(r["id"], r["key"]) for r in dictionary.candidates(texts, keys, "id", "text").collect()]
    assert len(moved) <= 8 and {(1, "angel & cia"), (2, "c"), (7, "uno dos tres")} <= set(moved)
    found = sorted(tuple(r) for r in dictionary.occurrences(texts, lexicon_, "id", "text").collect())
    assert found == [(1, "A"), (2, "B"), (7, "C")]
    assert dictionary.occurrences(texts, lexicon_.limit(0), "id", "text").count() == 0


def test_report_makes_one_pass_over_a_table(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(10, numPartitions=2).mapInArrow(count, "id long")
    checks = {"a": quality.at_least(rows, F.col("id") > 8), "b": quality.none_of(rows, F.col("id") > 8), "c": quality.all_of(rows, F.col("id") >= 5, F.col("id") > 4), "d": quality.all_of(rows, F.col("id") > 5, F.col("id") > 90)}
    got = {r["criterion"]: (r["status"], r["evidence"]) for r in quality.report(checks).collect()}
    assert got == {"a": ("PASS", 1), "b": ("FAIL", 1), "c": ("PASS", 5), "d": ("WARN", 0)} and seen.value == 10


def test_search_multiplies_few_rows_at_once(spark, monkeypatch):
    unit, over = vectors._unit, spark.sparkContext.accumulator(0)

    def counted(rows, dim):
        over.add(int(len(rows) > 1000))
        return unit(rows, dim)

    monkeypatch.setattr(vectors, "_unit", counted)
    v = spark.range(5000, numPartitions=1).select(F.col("id").alias("vec_id"), F.array(F.sin("id"), F.cos("id"), F.lit(0.5)).alias("embedding"))
    v = v.unionByName(spark.createDataFrame([(9000, None), (9001, [1.0])], "vec_id long, embedding array<double>")).coalesce(1)
    queries = v.where("vec_id in (3, 4999)").select(F.col("vec_id").alias("query_id"), "embedding")
    got = [tuple(r) for r in vectors.top_k_many(v, queries, 3).orderBy("query_id", "rank").select("query_id", "vec_id").collect()]
    monkeypatch.undo()
    assert got == [(q, r["vec_id"]) for q in (3, 4999) for r in vectors.top_k(v.where("vec_id < 9000"), list(queries.where(F.col("query_id") == q).first()["embedding"]), 3).orderBy("rank").collect()]
    assert over.value == 0


def test_stream_state_needs_no_python(spark, tmp_path):
    """Aggregates keep a guid's state: a first valid arrival, the last values, and each rejection, over several batches."""
    rows = [(1, "b", None), (1, "a", "BAD"), (2, "c", "WORSE"), (2, "d", "BAD"), (3, "e", None)]
    flat = spark.createDataFrame([("g", f"s{r}", dt.datetime(2026, 1, 1), a, r, why, why and why.lower()) for a, r, why in rows], "guid string, source string, published_ts timestamp, arrived long, row string, reason string, detail string")
    known = incremental._known(flat)
    assert "Python" not in known._jdf.queryExecution().executedPlan().toString() and "Pandas" not in known._jdf.queryExecution().executedPlan().toString()
    got = known.first().asDict()
    assert got.pop("published_ts") == dt.datetime(2026, 1, 1)
    assert got == {"guid": "g", "source": "se", "arrived": 1, "payload": "e", "rejected_at": 2, "first_rejected_at": 1, "times": 3, "reason": "BAD", "detail": "bad", "rejected": "d"}
    assert {(c.split()[0], c.split()[1]) for c in incremental._KNOWN.split(", ")} >= {(n, t.replace("bigint", "long")) for n, t in known.dtypes}


def _plan(df, part="analyzed"):
    return getattr(df._jdf.queryExecution(), part)().toString()


def test_norms_are_measured_once(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,)], "v array<double>").select(vectors.normalised(F.col("v")).alias("u"))
    assert [r["u"] for r in df.collect()] == [[0.6, 0.8], [0.0, 0.0], None]
    assert _plan(df).count("aggregate(") == 1


def test_replies_are_parsed_once_for_their_errors_and_fields(spark):
    rows = [(1, "ner", '{"sentimiento": "positive", "empresas": [ACME]}'), (1, "ma", "no json"), (2, "ner", "no"), (2, "ma", "no"), (3, "ma", "{}")]
    both = replies.combine_passes(spark.createDataFrame(rows, "guid long, pass string, reply_text string"))
    out = both.where("errors < 2").select("guid", "errors", replies.text(F.col("ner_reply"), "sentimiento").alias("s"), replies.texts(F.col("ner_reply"), "empresas").alias("e"))
    assert [tuple(r) for r in out.orderBy("guid").collect()] == [(1, 1, "positive", ["ACME"]), (3, 1, None, None)]
    # Two replies, each as it is and repaired, although a filter asks for their errors.
    assert _plan(out, "optimizedPlan").count("parseJson(") == 4
