"""Model replies: parse, repair, and hold to closed vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmarket.functions.lists import clamp01, clean_texts, within
from newsmarket.functions.text import bound, strip

SENTIMENTS = ["positive", "negative", "neutral"]
def unfenced(x: Column) -> Column:
    """Without markdown fences."""
    return strip(F.regexp_replace(x, r"(?m)^\s*```[A-Za-z]*\s*$", ""))


def repaired(x: Column) -> Column:
    """Bare upper-case words in arrays get quotes."""
    return F.regexp_replace(x, r'([\[,]\s*)([A-Z][A-Z0-9.*-]*)(?=\s*[\],])', '$1"$2"')


def parse(x: Column) -> Column:
    """The reply as a VARIANT object; null if neither the text nor its repaired form is one in JSON."""
    plain = unfenced(x)
    whole = lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), v)
    return F.coalesce(bound(F.try_parse_json(plain), whole), bound(F.try_parse_json(repaired(plain)), whole))


def field(reply: Column, name: str, kind: str = "variant") -> Column:
    """A field of a reply as a type; null if it is absent, null or of another type."""
    return F.try_variant_get(reply, f"$.{name}", kind)


def texts(reply: Column, name: str) -> Column:
    """The texts of a field that is a list, its other elements left out; null for a field that is none."""
    each = lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))
    return F.array_compact(F.transform(field(reply, name, "array<variant>"), each))


def text(reply: Column, name: str) -> Column:
    return bound(field(reply, name), lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))


def number(reply: Column, name: str) -> Column:
    """A number, a text that is one, or true and false as 1 and 0, moved into 0..1; else null."""
    said = field(reply, name, "string")
    return bound(field(reply, name), lambda v: F.when(F.schema_of_variant(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double")).otherwise(clamp01(said)))


def sanitize_ner(reply: Column, universe: list[str], sectors: list[str]) -> Column:
    """Tickers and sectors of the vocabularies, clean names, a known sentiment (else neutral) and a score in 0..1.

    Each field stands for itself: one of another type is as if it were absent.
    """
    mood, none = F.lower(strip(text(reply, "sentimiento"))), F.array().cast("array<string>")
    return F.struct(
        F.coalesce(within(clean_texts(texts(reply, "tickers")), universe), none).alias("tickers"),
        F.coalesce(within(clean_texts(texts(reply, "sectores")), sectors), none).alias("sectors"),
        F.coalesce(clean_texts(texts(reply, "personas")), none).alias("persons"),
        F.coalesce(clean_texts(texts(reply, "empresas")), none).alias("companies"),
        F.when(mood.isin(SENTIMENTS), mood).otherwise("neutral").alias("sentiment"),
        number(reply, "confianza_sentimiento").alias("sentiment_score"),
    )


def truthy(x: Column) -> Column:
    """Whether a JSON value (variant) is neither absent, null, false, zero nor empty."""
    said = F.to_json(x)
    return said.isNotNull() & ~said.isin("null", "false", '""', "[]", "{}") & F.coalesce(said.try_cast("double") != 0, F.lit(True))


def sanitize_ma(reply: Column, kinds: list[str], fintechs: list[str], sectors: list[str], lexicon_sector: Column) -> Column:
    """Event only if the flag is true and the kind is known and not none; the fintech flag follows from names
    in the dictionary; a missing sector falls back to the lexicon if there are fintechs. Any filled text, "false" too, is a true flag.
    """
    kind = F.lower(strip(text(reply, "tipo_ma")))
    event = F.coalesce(truthy(field(reply, "es_evento_ma")) & kind.isin([k for k in kinds if k != "none"]), F.lit(False))
    found = F.coalesce(within(clean_texts(texts(reply, "fintechs")), fintechs), F.array().cast("array<string>"))
    said = text(reply, "sector_afectado")
    sector = F.when(said.isin(sectors), said)
    return F.struct(
        event.alias("ma_event"),
        F.when(event, kind).otherwise("none").alias("ma_kind"),
        number(reply, "confianza_ma").alias("ma_score"),
        found.alias("fintechs"),
        (F.size(found) > 0).alias("fintech_flag"),
        F.coalesce(sector, F.when(F.size(found) > 0, lexicon_sector)).alias("sector_affected"),
    )


def combine_passes(replies: DataFrame) -> DataFrame:
    """guid, ner, ma, ner_reply, ma_reply, errors: the two passes of an item side by side, parsed, and how many of them failed."""
    out = replies.groupBy("guid").agg(*[F.max(F.when(F.col("pass") == p, F.col("reply_text"))).alias(p) for p in ("ner", "ma")])
    # Exploded, so a filter on the errors finds the replies parsed and does not parse them once more.
    parsed = F.explode(F.array(F.struct(parse(F.col("ner")).alias("ner_reply"), parse(F.col("ma")).alias("ma_reply"))))
    failed = [F.col(p).isNull().cast("int") for p in ("ner_reply", "ma_reply")]
    return out.select("*", parsed.alias("_p")).select("guid", "ner", "ma", "_p.*").withColumn("errors", failed[0] + failed[1])
