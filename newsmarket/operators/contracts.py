"""Contracts: ordered rules that give a row one rejection reason, or none.

Every contract returns its input with normalised columns, ``rejection_reason`` (null: valid) and
``rejection_detail``; ``split`` parts them, and no row is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmarket.functions.lists import clean_entities, clean_tickers
from newsmarket.functions.text import blank_to_null, bound, guid, iso_instant, strip

Rule = tuple[str, Column, str]  # reason, condition that breaks it, message


#: A reason that any other reason of a row wins over, whatever the order.
WEAK = "TYPE_MISMATCH"


def apply_rules(df: DataFrame, rules: list[Rule], first: int = 0) -> DataFrame:
    """The first broken rule gives the reason, those of WEAK after all others; the detail joins the
    messages of all broken rules (2048 characters). The ``first`` rules are preconditions: one that is
    broken ends the check with its own reason and message. Each condition is evaluated once.
    """

    def outcome(broken: Column) -> Column:
        at = [F.get(broken, F.lit(k)) for k in range(len(rules))]
        order = sorted(range(len(rules)), key=lambda k: rules[k][0] == WEAK)
        reason = F.coalesce(*[F.when(at[k], F.lit(rules[k][0])) for k in order])
        detail = F.left(F.concat_ws("; ", *[F.when(b, F.lit(m)) for b, (_, _, m) in zip(at, rules, strict=True)]), F.lit(2048))
        alone = F.coalesce(F.lit(None).cast("string"), *[F.when(at[k], F.lit(rules[k][2])) for k in range(first)])
        return F.struct(reason.alias("reason"), F.when(reason.isNotNull(), F.coalesce(alone, detail)).alias("detail"))

    found = bound(F.array(*[F.coalesce(c, F.lit(False)) for _, c, _ in rules]), outcome)
    out = df.withColumn("rejection_reason", found)
    return out.withColumns({"rejection_reason": F.col("rejection_reason.reason"), "rejection_detail": F.col("rejection_reason.detail")})


def with_absent(raw: DataFrame, types: dict[str, str]) -> tuple[DataFrame, list[Rule]]:
    """The columns with those that the input lacks as nulls, and a rule for each of the latter: absent is
    MISSING_FIELD, while a null is of the wrong type.
    """
    absent = [c for c in types if c not in raw.columns]
    raw = raw.withColumns({c: F.lit(None).cast(types[c]) for c in absent})
    return raw, [("MISSING_FIELD", F.lit(True), f"{c}: field is absent") for c in absent]


def split(df: DataFrame, payload_of: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the rest with their payload (all columns, or those named) as JSON."""
    payload = F.to_json(F.struct(*(payload_of or [c for c in df.columns if not c.startswith("rejection_")])))
    return df.where("rejection_reason is null").drop("rejection_reason", "rejection_detail"), df.where("rejection_reason is not null").withColumn("raw_payload", payload)


def news_contract(raw: DataFrame, sources: list[str], bypass: Column, limits: tuple[int, int, int] = (1024, 8192, 2048)) -> DataFrame:
    """source, title, content, url, published_at (text), tickers, sector, entities -> checked rows.

    Order: unknown source, blank url, date that is no ISO time, bad url, other field errors, and
    only then the missing entity, which ``bypass`` (a boolean column) can lift.
    """
    for c in ("source", "title", "content", "url", "sector"):
        raw = raw.withColumn(c, strip(c))
    raw = raw.withColumn("tickers", clean_tickers(F.col("tickers"))).withColumn("entities", clean_entities(F.col("entities")))
    raw = raw.withColumn("published_ts", iso_instant(F.col("published_at"))).withColumn("macro_bypass", bypass)
    url, n = F.col("url"), F.length
    bad = lambda c, most: F.col(c).isNull() | (n(c) < 1) | (n(c) > most)
    absolute = url.rlike(r"^(?i)https?://[^\s/?#]+") & F.try_parse_url(url, F.lit("HOST")).isNotNull()
    entity = F.col("tickers").isNotNull() | blank_to_null(F.col("sector")).isNotNull() | F.col("entities").isNotNull()
    rules = [
        ("UNKNOWN_SOURCE", F.col("source").isNull() | ~F.col("source").isin(sources), "source: unknown"),
        ("INVALID_URL", blank_to_null(url).isNull(), "url: blank"),
        ("INVALID_DATE", F.col("published_ts").isNull(), "published_at: no ISO time"),
        ("INVALID_URL", ~absolute | (n(url) > limits[2]), "url: not absolute or too long"),
        ("TYPE_MISMATCH", bad("title", limits[0]), f"title: no text of 1 to {limits[0]} characters"),
        ("TYPE_MISMATCH", bad("content", limits[1]), f"content: no text of 1 to {limits[1]} characters"),
        ("TYPE_MISMATCH", n("sector") > 64, "sector: more than 64 characters"),
    ]
    clean = ~bad("title", limits[0]) & ~bad("content", limits[1]) & ~F.coalesce(n("sector") > 64, F.lit(False))
    entity_rule = ("MISSING_ENTITY", clean & ~entity & ~F.coalesce(F.col("macro_bypass"), F.lit(False)), "no ticker, sector or entity")
    out = apply_rules(raw, [*rules, entity_rule], first=3)
    keyed = blank_to_null(F.col("source")).isNotNull() & blank_to_null(url).isNotNull() & F.col("published_ts").isNotNull()
    return out.withColumn("guid", F.when(keyed, guid(F.col("source"), url, F.col("published_ts"))))


def price_contract(raw: DataFrame) -> DataFrame:
    """ticker, date, open, high, low, close, adj_close, volume -> checked rows.

    The first absent or out-of-range field in this order wins over those of the wrong type (null, or a
    bad ticker); NaN is out of range. The day's coherence is tested only if all fields pass.
    """
    prices = ("open", "high", "low", "close", "adj_close")
    raw, absent = with_absent(raw, {"ticker": "string", "date": "date"} | dict.fromkeys(prices, "double") | {"volume": "long"})
    lacking = {message.split(":")[0] for _, _, message in absent}
    raw = raw.withColumn("ticker", F.upper(strip("ticker")))
    rules: list[Rule] = []
    for c in ("ticker", "date", *prices, "volume"):
        wrong = F.col(c).isNull() | ~F.length("ticker").between(1, 32) if c == "ticker" else F.col(c).isNull()
        out_of_range = F.col(c) < 0 if c == "volume" else (F.col(c) <= 0) | F.isnan(c) if c in prices else F.lit(False)
        rules += [r for r in absent if r[2].startswith(f"{c}:")] if c in lacking else [("OUT_OF_RANGE", out_of_range, f"{c}: out of range"), (WEAK, wrong, f"{c}: null or of the wrong type")]
    passed = F.lit(True)
    for _, broken, _ in rules:
        passed = passed & ~F.coalesce(broken, F.lit(False))
    low, high = F.col("low"), F.col("high")
    coherence = [(low > high, "low is above high"), (~F.col("open").between(low, high), "open is outside the day's range"), (~F.col("close").between(low, high), "close is outside the day's range")]
    return apply_rules(raw, [*rules, *(("OUT_OF_RANGE", passed & broken, message) for broken, message in coherence)])


def macro_contract(raw: DataFrame) -> DataFrame:
    """series_id, date, value -> checked rows; values of any sign, and NaN, pass."""
    raw, absent = with_absent(raw, {"series_id": "string", "date": "date", "value": "double"})
    lacking = {message.split(":")[0] for _, _, message in absent}
    raw = raw.withColumn("series_id", F.upper(strip("series_id")))
    wrong = {"series_id": F.col("series_id").isNull() | ~F.length("series_id").between(1, 32), "date": F.col("date").isNull(), "value": F.col("value").isNull()}
    return apply_rules(raw, [*absent, *((WEAK, c, f"{name}: null or of the wrong type") for name, c in wrong.items() if name not in lacking)])


# The measures of a statement.
MEASURES = ("ingresos_totales", "utilidad_neta", "utilidad_por_accion", "activo_total", "pasivo_total", "capital_contable", "flujo_operativo", "flujo_libre")


# Characters that the names of a dictionary may have.
DICTIONARY_LIMITS = {"legal_name": 256, "commercial_name": 128, "sector": 64, "ticker": 32}


def fundamental_contract(raw: DataFrame) -> DataFrame:
    """ticker, period_end and up to eight measures -> checked rows; absent measures are null.

    An absent ticker or period is a missing field; assets that are not positive or liabilities below
    zero, or no numbers, are out of range; a null or blank ticker, one of over 32 characters and a null
    period are of the wrong type. Only a row without these faults is asked for a measure at all.
    """
    raw, absent = with_absent(raw, {"ticker": "string", "period_end": "date"})
    lacking = {message.split(":")[0] for _, _, message in absent}
    for c in MEASURES:
        raw = raw.withColumn(c, F.col(c).cast("double") if c in raw.columns else F.lit(None).cast("double"))
    raw = raw.withColumn("ticker", F.upper(strip("ticker")))
    wrong = {"ticker": F.col("ticker").isNull() | ~F.length("ticker").between(1, 32), "period_end": F.col("period_end").isNull()}
    rules: list[Rule] = [*absent, *((WEAK, c, f"{name}: null or of the wrong type") for name, c in wrong.items() if name not in lacking)]
    for c, bad in (("activo_total", F.col("activo_total") <= 0), ("pasivo_total", F.col("pasivo_total") < 0)):
        rules.append(("OUT_OF_RANGE", bad | F.isnan(c), f"{c}: out of range"))
    passed = F.lit(True)
    for _, broken, _ in rules:
        passed = passed & ~F.coalesce(broken, F.lit(False))
    return apply_rules(raw, [*rules, ("MISSING_FIELD", passed & F.coalesce(*MEASURES).isNull(), "no measure")])


def dictionary_contract(raw: DataFrame) -> DataFrame:
    """legal_name, commercial_name, ticker, sector, country -> valid rows with ``listed``; others are dropped.

    Texts are trimmed and have 1 to the characters of ``DICTIONARY_LIMITS``; a blank ticker is none; an absent country is MX.
    """
    raw = raw if "country" in raw.columns else raw.withColumn("country", F.lit("MX"))
    out = raw.select(*[strip(c).alias(c) for c in ("legal_name", "commercial_name", "sector")], F.upper(blank_to_null(F.col("ticker"))).alias("ticker"), F.upper(strip("country")).alias("country"))
    ok = F.coalesce(F.length("ticker"), F.lit(0)) <= DICTIONARY_LIMITS["ticker"]
    for c in ("legal_name", "commercial_name", "sector"):
        ok = ok & F.length(c).between(1, DICTIONARY_LIMITS[c])
    return out.where(ok & (F.length("country") == 2)).withColumn("listed", F.col("ticker").isNotNull())


def route(df: DataFrame, routes: dict[str, list[str]], retired: list[str] | None = None) -> DataFrame:
    """Adds ``contract``: where a source goes; marker rows and retired series are 'skipped', others 'unknown'."""
    out = F.lit("unknown")
    for name, sources in routes.items():
        out = F.when(F.col("source").isin(sources), name).otherwise(out)
    if retired:
        out = F.when(F.col("series_id").isin(retired), "skipped").otherwise(out)
    return df.withColumn("contract", F.when(F.coalesce(F.col("is_marker"), F.lit(False)), "skipped").otherwise(out))


def summary(checked: DataFrame) -> DataFrame:
    """Rows for each source and reason ('VALID' for none)."""
    return checked.groupBy("source", F.coalesce("rejection_reason", F.lit("VALID")).alias("reason")).agg(F.count("*").alias("n_rows"))


def run_summary(checked: DataFrame, target: DataFrame, key: str = "guid", skipped: Column | None = None) -> DataFrame:
    """source, n_new, n_updated, n_quarantined, n_skipped of one run against the target it is loaded into.

    Valid rows are applied one by one: the first of a key that the target lacks is new, the others
    are updates. Rows for which ``skipped`` holds count as nothing else. Running the same rows
    against the loaded target gives n_new = 0.
    """
    skip = F.coalesce(skipped, F.lit(False)) if skipped is not None else F.lit(False)
    kind = F.when(skip, "s").when(F.col("rejection_reason").isNotNull(), "q").otherwise("v")
    per_key = checked.select("source", F.when(kind == "v", F.col(key)).alias(key), kind.alias("kind")).groupBy("source", key, "kind").agg(F.count("*").alias("n"))
    known = target.select(F.col(key), F.lit(True).alias("known_")).distinct()
    per_key = per_key.join(known, key, "left")
    fresh = F.when((F.col("kind") == "v") & F.col("known_").isNull(), 1).otherwise(0)
    count = lambda k: F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0))
    out = per_key.groupBy("source").agg(F.sum(fresh).cast("long").alias("n_new"), count("v").alias("n_valid"), count("q").alias("n_quarantined"), count("s").alias("n_skipped"))
    return out.select("source", "n_new", (F.col("n_valid") - F.col("n_new")).alias("n_updated"), "n_quarantined", "n_skipped")
