"""Surrogates for personal data: keyed, of the same type and format, distinct and coreferent.

Entities are e-mail addresses, card numbers, IP addresses, phone numbers, IBANs, social security
numbers, secrets after a label and titled names. An entity's canonical form (lower case, digits, a
name) gets a surrogate from a keyed hash; mentions are written in their own format. Distinct
canonical forms get distinct surrogates, none of which is a canonical form in the corpus: what
collides is hashed again. A name is replaced word by word, given names by one of the same gender
(of the title, else of the name) and script. Later mentions of a text's given and family names, with
or without a title, are the same person. All of it is DataFrame operations.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, shared_dir, stored

#: Setting that holds the key of the query; without it each run makes a key of its own.
KEY_SETTING = "newsmarket.surrogate.key"
ATTEMPTS = 30

# Titles by gender, given names by gender and script.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Mister", "господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа"],
    "n": ["Dr", "Prof", "Mx"],
}
GIVEN = {
    "m": ["Adam", "Bruno", "Carl", "Daniel", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leo", "Martin", "Noah", "Oscar", "Paul", "Simon", "Thomas", "Victor", "Walter"],
    "f": ["Alice", "Bella", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Irene", "Julia", "Karin", "Laura", "Maria", "Nora", "Olga", "Paula", "Sara", "Teresa", "Vera", "Wanda"],
    "n": ["Alex", "Robin", "Sascha", "Kim", "Noel", "Jamie", "Charlie", "Sam", "Toni", "Dominique"],
    "m-cyr": ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим"],
    "f-cyr": ["Анна", "Вера", "Галина", "Дарья", "Елена", "Зоя", "Ирина", "Ксения", "Лидия", "Мария"],
    "n-cyr": ["Саша", "Женя", "Валя", "Слава", "Паша", "Тоня"],
}
SYLLABLES = ["ba", "ce", "di", "fo", "gu", "ha", "je", "ki", "lo", "mu", "na", "pe", "ri", "so", "tu", "va", "we", "xi", "yo", "zu"]
SYLLABLES_CYR = ["ба", "ве", "ги", "до", "жу", "за", "ке", "ли", "мо", "ну", "па", "ре", "си", "то", "фу", "ха", "це", "чи", "шо", "ю"]

_WORD = r"\p{Lu}[\p{L}'’-]*+"
# Particles of family names; they stay as they are.
PARTICLES = ["de", "del", "de la", "la", "las", "los", "da", "das", "do", "dos", "di", "du", "le", "van", "von", "der", "den", "ter", "ten", "zu", "zur", "bin", "ibn", "al", "el"]
_PARTICLE = r"(?:(?i:" + "|".join(p for p in PARTICLES if " " not in p) + r")[ \t]{1,3})"
_INITIAL = r"\p{Lu}\.(?:[ \t]{1,3}|(?=\p{Lu}))"
_GAP = r"[ \t\u00a0]{0,3}(?:\r?\n)?[ \t\u00a0]{0,3}"
_TITLE, _TITLE_UP = ("(?:" + "|".join(f(t) for g in TITLES.values() for t in g) + r")\b\.?" for f in (str, str.upper))
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "secret": r"(?<=[\"'=: ])(?=[0-9a-fA-F]*[0-9])(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{32,128}(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}]|\.\d)",
    "card": r"(?<![\p{L}\p{N}])(?!(?:19|20)\d\d-[01]\d-[0-3]\d\b)(?:\d[ -]?){12,18}\d(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip6": r"(?<![\p{L}\p{N}:.])(?:(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|(?=[0-9a-fA-F]{0,3}\d)[0-9a-fA-F]{4}(?::[0-9a-fA-F]{1,4}){0,5}::(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,5})?)(?![\p{L}\p{N}:])",
    "phone": r"(?<![\p{L}\p{N}])(?<!\d{4}-\d\d-)(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]\d{3,4}(?![\p{L}\p{N}])|(?<![\p{L}\p{N}.,-])[2-9]\d{9}(?![\p{L}\p{N}]|[.,-]\d)",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE}(?=\s){_GAP}(?:{_INITIAL}){{0,3}}{_PARTICLE}{{0,3}}{_WORD}(?:[ \t]{{1,3}}(?:{_INITIAL}){{0,2}}{_PARTICLE}{{0,3}}{_WORD})?|{_TITLE_UP}(?=\s){_GAP}\p{{Lu}}{{2,}}(?:[ \t]{{1,3}}\p{{Lu}}{{2,}})?)",
}
# A look at the next character goes before the alternatives, as most places start no entity.
_INITIALS = "".join(sorted({t[0] for g in TITLES.values() for t in g} | {t[0].upper() for g in TITLES.values() for t in g}))
_NUMBERS = rf"(?=[0-9+(])(?:{PATTERNS['ip']}|{PATTERNS['ssn']}|{PATTERNS['card']}|{PATTERNS['phone']})"
_CODES = rf"(?=[0-9a-fA-F]{{1,4}}:){PATTERNS['ip6']}|(?=[A-Z]{{2}}\d){PATTERNS['iban']}"
_NO_MAIL = rf"{_CODES}|{_NUMBERS}|(?=[0-9a-fA-F]){PATTERNS['secret']}|(?=[{_INITIALS}]){PATTERNS['name']}"
ENTITY = rf"(?=[^\s@]){PATTERNS['email']}|{_NO_MAIL}"
_MAYBE = rf"[0-9@]|(?=[{_INITIALS}])(?:{_TITLE}|{_TITLE_UP})"
_ALPHABETS = {"digit": "0123456789", "lower": "abcdefghijklmnopqrstuvwxyz", "hex": "0123456789abcdef"}


def kind_of(mention: Column) -> Column:
    """The first pattern that takes the whole mention."""
    out = F.lit("name")
    for kind in ("card", "phone", "iban", "ssn", "ip6", "ip", "secret", "email"):
        whole = PATTERNS[kind] if kind != "secret" else r"[0-9a-fA-F]{32,128}"
        out = F.when(mention.rlike(f"^(?:{whole})$"), F.lit(kind)).otherwise(out)
    return out


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def _pick(k: Column | int, n: Column | int) -> Column:
    """A number below n from the k-th (0..) of the keyed numbers in column ``_n``."""
    k = F.lit(k) if isinstance(k, int) else k
    return F.pmod(F.element_at("_n", F.pmod(k, F.lit(31)) + 1) + k, F.lit(n) if isinstance(n, int) else n).cast("int")


def _letter_of(alphabet: str, i: Column) -> Column:
    return F.substring(F.lit(alphabet), _pick(i, len(alphabet)) + 1, F.lit(1))


def _same_shape(kind: Column, text: Column) -> Column:
    """Digits for digits, letters for letters, hex digits in a secret; a phone's country code stays."""
    chars = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substring(text, i, F.lit(1)))
    keep = F.when(kind == "phone", F.instr(text, " ")).when(kind == "iban", F.lit(5)).otherwise(F.lit(0))

    def one(ch: Column, i: Column) -> Column:
        plain = F.when(ch.between("0", "9"), _letter_of(_ALPHABETS["digit"], i)).when(ch.rlike(r"\p{L}"), _letter_of(_ALPHABETS["lower"], i)).otherwise(ch)
        return F.when(i < keep, ch).when((kind == "secret") | (kind == "ip6") & (ch != ":"), _letter_of(_ALPHABETS["hex"], i)).otherwise(plain)

    return F.array_join(F.transform(chars, one), "")


def luhn_ok(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    n = F.length(digits)
    one = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(digits, i, F.lit(1)).cast("int") * F.when(F.pmod(n - i, F.lit(2)) == 1, 2).otherwise(1))
    return F.aggregate(one, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _iban(shaped: Column) -> Column:
    """A lower-case IBAN with the check digits that its country and account need, in upper case."""
    up = F.upper(shaped)
    moved = F.concat(F.substring(up, F.lit(5), F.length(up)), F.substring(up, 1, 2), F.lit("00"))
    digits = F.transform(F.sequence(F.lit(1), F.length(moved)), lambda i: F.substring(moved, i, F.lit(1)))
    left = F.aggregate(digits, F.lit(0), lambda s, ch: F.when(ch.between("0", "9"), (s * 10 + ch.try_cast("int")) % 97).otherwise((s * 100 + F.ascii(ch) - 55) % 97))
    return F.concat(F.substring(up, 1, 2), F.lpad((F.lit(98) - left).cast("string"), 2, "0"), F.substring(up, F.lit(5), F.length(up)))


def _check_digit(digits: Column) -> Column:
    """The last digit that makes the whole right, for digits without it."""
    found = F.filter(F.sequence(F.lit(0), F.lit(9)), lambda d: luhn_ok(F.concat(digits, d.cast("string"))))
    return F.element_at(found, 1).cast("string")


def _with_surrogate(values: DataFrame, attempt: int, key: str) -> DataFrame:
    """kind, value, surrogate; name parts have kinds given-<gender> and family."""
    kind, value = F.col("kind"), F.col("value")
    bits = values.select("kind", "value", F.sha2(F.concat_ws("|", F.lit(key), kind, value, F.lit(str(attempt))), 512).alias("_h"))
    numbers = F.transform(F.sequence(F.lit(0), F.lit(30)), lambda i: F.conv(F.substring("_h", i * 4 + 1, F.lit(4)), 16, 10).cast("int"))
    shaped = bits.withColumn("_n", numbers).withColumn("_s", F.when(kind.isin("email", "card", "phone", "secret", "ssn", "iban", "ip6"), _same_shape(kind, value)))
    dot = F.length(value) - F.instr(F.reverse(value), ".") + 1  # the top-level domain stays
    email = F.concat(F.substring("_s", F.lit(1), dot - 1), F.substring(value, dot, F.length(value)))
    ip = F.concat_ws(".", *[(_pick(i, 254) + 1).cast("string") for i in range(4)])
    shaped = shaped.withColumn("_head", F.substring("_s", F.lit(1), F.length("_s") - 1))
    card = F.when(luhn_ok(value), F.concat("_head", _check_digit(F.col("_head")))).otherwise(F.col("_s"))
    cyrillic = value.rlike(r"\p{IsCyrillic}")
    given = F.lit(None).cast("string")
    for gender in ("m", "f", "n"):
        lists = [F.array(*map(F.lit, GIVEN[gender + s])) for s in ("", "-cyr")]
        one = lambda names, n, k: F.element_at(names, F.pmod(_pick(0, n) + k, F.lit(n)) + 1)
        # Where the name drawn is the real one, or begins it, the next is taken.
        other = lambda names, n: F.when(value.startswith(F.lower(one(names, n, 0))) | F.lower(one(names, n, 0)).startswith(value), one(names, n, 1)).otherwise(one(names, n, 0))
        words = F.when(cyrillic, other(lists[1], len(GIVEN[gender + "-cyr"]))).otherwise(other(lists[0], len(GIVEN[gender])))
        given = F.when(kind == f"given-{gender}", words).otherwise(given)
    # Given names are few: from the second attempt on they get syllables, as many as the attempt.
    syllable = lambda i: F.when(cyrillic, F.element_at(F.array(*map(F.lit, SYLLABLES_CYR)), _pick(i, 20) + 1)).otherwise(F.element_at(F.array(*map(F.lit, SYLLABLES)), _pick(i, 20) + 1))
    tail = lambda n: F.concat(*[syllable(i) for i in range(1, n + 1)])
    if attempt:
        given = F.concat(given, tail(attempt + 1))
    family = F.initcap(tail(3 + attempt))
    out = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "iban", _iban(F.col("_s"))).when(kind.isin("phone", "secret", "ssn", "ip6"), F.col("_s")).when(kind == "family", family).otherwise(given)
    return shaped.select("kind", "value", out.alias("surrogate"))


def _gender(mention: Column, given: Column) -> Column:
    """Of the title; where that tells nothing, of the given name (in lower case) if it is a known one."""
    first = F.lower(F.regexp_extract(mention, r"^(\p{L}+)", 1))
    out = F.lit("n")
    for g in ("m", "f"):
        out = F.when(given.isin([n.lower() for n in GIVEN[g] + GIVEN[f"{g}-cyr"]]), F.lit(g)).otherwise(out)
    for g in ("m", "f"):
        out = F.when(first.isin([t.lower() for t in TITLES[g]]), F.lit(g)).otherwise(out)
    return out


def _parts(kind: Column, mention: Column) -> Column:
    """array<struct<kind, value, word>>: the canonical values of a mention and its words.

    A name has a part for each word after the title: given names, the family name (the last word), and
    particles and initials, which are of the kind ``kept``: the former stay, the latter become ``X.``.
    """
    part = lambda k, v, w: F.struct(k.alias("kind"), v.alias("value"), w.alias("word"))
    words, none = _name_words(mention), F.lit(None).cast("string")
    first = F.lower(F.element_at(words, 1))

    def of(w: Column, i: Column) -> Column:
        last, initial = i == F.size(words) - 1, w.rlike(r"^\p{Lu}\.$")
        kept = ~last & (initial | F.lower(w).isin([p for p in PARTICLES if " " not in p]))
        kind_ = F.when(kept, "kept").when(last, "family").otherwise(F.concat(F.lit("given-"), _gender(mention, first)))
        return part(kind_, F.when(kept & initial, "X.").when(kept, w).otherwise(F.lower(w)), F.when(~kept, w))

    name = F.transform(words, of)
    phone = F.when(mention.startswith("+"), F.concat(F.regexp_extract(mention, r"^(\+\d{1,3})", 1), F.lit(" "), _digits(F.regexp_replace(mention, r"^\+\d{1,3}", "")))).otherwise(F.concat(F.lit("+ "), _digits(mention)))
    value = F.when(kind == "phone", phone).when(kind.isin("card", "ssn"), _digits(mention)).when(kind == "iban", F.lower(F.replace(mention, F.lit(" ")))).otherwise(F.lower(mention))
    return F.when(kind == "name", name).otherwise(F.array(part(kind, value, none)))


_AFTER_TITLE = r"(?U)^\S+\s+"


def _name_words(mention: Column) -> Column:
    """The words of a titled name without the title; initials written together are parted."""
    return F.filter(F.split(F.regexp_replace(F.regexp_replace(mention, _AFTER_TITLE, ""), r"(\p{Lu}\.)(?=\p{Lu})", "$1 "), r"(?U)\s+"), lambda w: w != "")


def _written(kind: Column, mention: Column, found: Column) -> Column:
    """Surrogate parts in the format of the mention."""
    first = F.element_at(found, 1)
    digits = F.when(kind == "phone", F.substring_index(first, " ", -1)).otherwise(first)
    keep = F.when((kind == "phone"), F.length(F.regexp_extract(mention, r"^(\+\d{1,3})?", 0))).otherwise(F.lit(0))
    chars = F.transform(F.sequence(F.lit(1), F.greatest(F.length(mention), F.lit(1))), lambda i: F.substring(mention, i, F.lit(1)))
    filled = F.array_join(
        F.transform(
            chars,
            lambda ch, i: F.when(ch.rlike("[0-9]") & (i >= keep), F.substring(digits, F.length(_digits(F.substring(mention, F.lit(1), i + 1))) - F.length(_digits(F.substring(mention, F.lit(1), keep))), F.lit(1))).otherwise(ch),
        ),
        "",
    )
    cased = F.when((mention == F.upper(mention)) & (mention != F.lower(mention)), F.upper(first)).otherwise(first)
    spaced = F.array_join(F.transform(chars, lambda ch, i: F.when(ch == " ", ch).otherwise(F.substring(first, F.length(F.replace(F.substring(mention, F.lit(1), i + 1), F.lit(" "))), F.lit(1)))), "")
    # The title, then the words with the white space that was between them.
    rest = F.regexp_replace(F.regexp_replace(mention, _AFTER_TITLE, ""), r"(\p{Lu}\.)(?=\p{Lu})", "$1 ")
    gaps = F.concat(F.regexp_extract_all(rest, F.lit(r"(?U)\s+"), F.lit(0)), F.array(F.lit("")))
    name = F.concat(F.regexp_extract(mention, _AFTER_TITLE, 0), F.array_join(F.zip_with(found, gaps, lambda w, g: F.concat(w, F.coalesce(g, F.lit("")))), ""))
    name = F.when(mention == F.upper(mention), F.upper(name)).otherwise(name)
    return F.when(kind.isin("phone", "card", "ssn"), filled).when(kind == "iban", spaced).when(kind == "name", name).otherwise(cased)


def surrogates(values: DataFrame, key: str) -> DataFrame:
    """kind, value, surrogate for distinct (kind, value): distinct surrogates of a kind, none of them a value.

    What loses a collision (the greater value) or meets a real value tries again with another
    hash; after ATTEMPTS rounds an error is raised rather than a clash returned.
    """
    path = shared_dir(values.sparkSession)
    values = stored(values.select("kind", "value").distinct(), f"{path}/values")
    open_, done = values, None
    group = F.when(F.col("kind").startswith("given"), "given").otherwise(F.col("kind"))
    for attempt in range(ATTEMPTS):
        tried = _with_surrogate(open_, attempt, key).withColumn("group", group)
        tried = stored(tried, f"{path}/tried{attempt}")
        real = values.select(group.alias("group"), F.col("value").alias("surrogate_low")).distinct()
        first = tried.groupBy("group", F.lower("surrogate").alias("surrogate_low")).agg(F.min(F.struct("kind", "value")).alias("w"))
        free = first.join(real, ["group", "surrogate_low"], "left_anti")
        if done is not None:
            free = free.join(done.select(group.alias("group"), F.lower("surrogate").alias("surrogate_low")), ["group", "surrogate_low"], "left_anti")
        won = tried.join(free.select("w.kind", "w.value"), ["kind", "value"]).select("kind", "value", "surrogate")
        won = stored(won, f"{path}/won{attempt}")
        done = won if done is None else done.unionByName(won)
        open_ = stored(open_.join(won, ["kind", "value"], "left_anti"), f"{path}/open{attempt}")
        if open_.isEmpty():
            return done
    raise RuntimeError("surrogates still collide")


def _word_pattern(word: Column) -> Column:
    """A word by itself, but not before a number: a month, a street or a version is no person."""
    return F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), F.replace(word, F.lit(r"\E")), F.lit(r"\E(?![\p{L}\p{N}]|[ \t]\p{N})"))


def _with_known_names(names: Column, text: Column) -> Column:
    """A struct of the text with the words of known names (array<struct<word, surrogate>>) replaced, and how many."""
    count = F.aggregate(names, F.lit(0), lambda n, x: n + F.regexp_count(text, _word_pattern(x["word"])))
    new = F.aggregate(names, text, lambda t, x: F.regexp_replace(t, _word_pattern(x["word"]), x["surrogate"]))
    return F.struct(count.alias("n"), new.alias("text"))


def replaced(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, entities, text for each row of docs: texts with every entity replaced, by surrogates of the secret ``key``.

    Null texts stay null with no entities; repeated rows get the same text; other columns, whatever
    their names, are ignored. Only texts with entities are moved, and equal texts are worked on once.
    """
    if not key:
        raise ValueError("surrogates need a secret key")
    path = shared_dir(docs.sparkSession)
    text, mail = F.col("text"), F.contains("text", F.lit("@"))
    both = lambda f: F.when(mail, f(ENTITY)).otherwise(f(_NO_MAIL))  # noqa: E731  a text without the sign holds no address
    hits = F.when(text.rlike(_MAYBE), both(lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(0))))
    # Written once, so that each text is searched once.
    marked = stored(docs.select(F.col("doc_id").cast("long"), "text", hits.alias("hits")), f"{path}/marked")
    without = marked.where("coalesce(size(hits), 0) <= 0").select("doc_id", F.lit(0).alias("entities"), "text")
    some = marked.where("size(hits) > 0").withColumn("k", F.md5("text"))
    found = stored(some.groupBy("k").agg(F.first("hits").alias("hits")), f"{path}/found")
    mentions = found.select("k", F.posexplode("hits").alias("at", "mention")).withColumn("kind", kind_of(F.col("mention")))
    parts = mentions.select("k", "at", "mention", F.col("kind").alias("of"), F.posexplode(_parts(F.col("kind"), F.col("mention"))).alias("part", "p")).select("k", "at", "mention", "of", "part", "p.*")
    parts = stored(parts, f"{path}/parts")
    named = parts.where("kind <> 'kept'")
    table = surrogates(named, key)
    kept = parts.where("kind = 'kept'").withColumn("surrogate", F.col("value"))
    given = stored(named.join(table, ["kind", "value"]).unionByName(kept), f"{path}/given")
    new = given.groupBy("k", "at", "mention", "of").agg(F.transform(F.array_sort(F.collect_list(F.struct("part", "surrogate"))), lambda x: x["surrogate"]).alias("found"))
    new = new.select("k", "at", _written(F.col("of"), F.col("mention"), F.col("found")).alias("new"))
    new = new.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "new"))), lambda x: x["new"]).alias("new"))
    # The words of a text's names, as they were written, with a capital and in capitals; longer ones first.
    forms = F.array(F.struct("word", "surrogate"), F.struct(F.initcap("value").alias("word"), "surrogate"), F.struct(F.upper("value").alias("word"), F.upper("surrogate").alias("surrogate")))
    # The first spelling of capitals wins, so a word written in capitals gets a surrogate in capitals.
    names = given.where("word is not null and length(word) > 1").select("k", F.explode(forms).alias("f")).select("k", "f.word", F.when((F.col("f.word") == F.upper("f.word")), F.upper("f.surrogate")).otherwise(F.col("f.surrogate")).alias("surrogate"))
    names = names.groupBy("k", "word").agg(F.min("surrogate").alias("surrogate")).groupBy("k").agg(F.sort_array(F.collect_list(F.struct((-F.length("word")).alias("n"), "word", "surrogate"))).alias("names"))
    gaps = both(lambda p: F.split("text", p, -1))
    with_ = some.select("doc_id", "k", gaps.alias("gaps")).join(new, "k").join(names, "k", "left")
    plain = F.transform("gaps", lambda g: F.struct(F.lit(0).alias("n"), g.alias("text")))
    # A word that the text also writes small is a common one, which is replaced after a title only.
    common = lambda x: (F.lower(x["word"]) != x["word"]) & F.exists("gaps", lambda g: F.regexp_like(g, _word_pattern(F.lower(x["word"]))))
    with_ = with_.withColumn("names", F.filter("names", lambda x: ~common(x)))
    again = F.when(F.col("names").isNull(), plain).otherwise(F.transform("gaps", lambda g: _with_known_names(F.col("names"), g)))
    with_ = with_.withColumn("again", again)
    whole = F.array_join(F.zip_with("again", "new", lambda g, n: F.concat(g["text"], F.coalesce(n, F.lit("")))), "")
    entities = F.size("new") + F.aggregate("again", F.lit(0), lambda s, g: s + g["n"])
    return with_.select("doc_id", entities.alias("entities"), whole.alias("text")).unionByName(without)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replaced(read(spark, sf_dir, "documents"), spark.conf.get(KEY_SETTING, None) or secrets.token_hex(32))
