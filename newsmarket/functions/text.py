"""Text functions as columns; nothing leaves the JVM."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from html import entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from .html import MARKUP


def _unmarked(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")


# Letters with marks and the letters they fold to, of the Latin, Greek and Cyrillic blocks.
_LETTERS = {c: _unmarked(c) for c in map(chr, range(0x80, 0x2000)) if c == c.lower() and len(_unmarked(c)) == 1 != (_unmarked(c) == c)}
MARKED, PLAIN = "".join(_LETTERS), "".join(_LETTERS.values())
# Months by name.
MONTHS = {"enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12}


#: All white space, of ASCII and beyond.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(x: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(x, F.lit(BLANKS))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fold(x: Column) -> Column:
    """Lower case without marks, precomposed or combining."""
    low = F.lower(x)
    return F.when(_beyond_ascii(x), F.regexp_replace(F.translate(low, MARKED, PLAIN), r"\p{Mn}", "")).otherwise(low)


def _beyond_ascii(x: Column) -> Column:
    return F.octet_length(x) != F.char_length(x)


def folded(term: str) -> str:
    """The same for a literal."""
    return "".join(c for c in term.lower().translate(str.maketrans(MARKED, PLAIN)) if unicodedata.category(c) != "Mn")


def whole_word(term: str) -> str:
    """Pattern of a term that is not part of a longer word; the term comes first, as most places hold none."""
    t = rf"\Q{folded(term)}\E"
    return rf"(?U){t}(?<!\w{t})(?!\w)"


def with_terms(text: Column, terms: list[str], use: Callable[[Callable[[list[str]], Column]], Column]) -> Column:
    """``use(has)``, where ``has(some)`` tells whether any of those terms is in the text as a whole word.

    The text is split into words once and those with letters beyond ASCII are folded, which joins and
    parts no words. Terms of one word are looked up among them; others are searched where the folded
    text contains them.
    """
    single = {t for t in map(folded, terms) if re.fullmatch(r"\w+", t)}
    known = F.array(*map(F.lit, sorted(single))) if single else F.array().cast("array<string>")

    def of(hit: Column, low: Column | None) -> Column:
        def has(some: list[str]) -> Column:
            out = F.lit(False)
            for t in map(folded, some):
                out = out | (F.array_contains(hit, t) if t in single else F.contains(low, F.lit(t)) & low.rlike(whole_word(t)))
            return out

        return use(has)

    def hits(words: Column) -> Column:
        marked = fold(F.array_join(F.filter(words, _beyond_ascii), " "))
        return F.array_union(F.array_intersect(words, known), F.array_intersect(F.split(marked, " "), known))

    hit = bound(F.split(F.lower(text), r"(?U)\W+"), hits)
    if all(t in single for t in map(folded, terms)):
        return bound(hit, lambda h: of(h, None))
    return bound(hit, lambda h: bound(fold(text), lambda low: of(h, low)))


def terms_present(text: Column, terms: list[str]) -> Column:
    """Distinct terms that occur as whole words, in the order given."""
    return with_terms(text, terms, lambda has: F.array_compact(F.array(*[F.when(has([t]), F.lit(t)) for t in dict.fromkeys(terms)])))


def blank_to_null(x: Column) -> Column:
    return F.nullif(strip(x), F.lit(""))


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*map(blank_to_null, columns))


def longest(*columns: Column) -> Column:
    """The longest trimmed text, the first of equals; null if all are blank."""
    out = blank_to_null(columns[0])
    for c in columns[1:]:
        other = blank_to_null(c)
        out = F.when(F.coalesce(F.length(other), F.lit(0)) > F.coalesce(F.length(out), F.lit(0)), other).otherwise(out)
    return out


_NAMES = sorted((n for n in entities.html5 if n.endswith(";")), key=lambda n: n[:-1] not in entities.name2codepoint)
_LEGACY = sorted((n for n in entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
# Numbers that stand for the characters of the Windows code page.
PAGE = {n: bytes([n]).decode("cp1252") for n in range(0x80, 0xA0) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
REFERENCE = "&(?:#[0-9]{1,9};?|#[xX][0-9a-fA-F]{1,8};?|[A-Za-z][A-Za-z0-9]{1,31};|" + "|".join(_LEGACY) + ")"
_TAG = f"(?is){MARKUP}"
_EDGE_BLANKS = r"(?U)^\s+|\s+$"


def _character(ref: Column) -> Column:
    """What a character reference stands for; an unknown name stays."""
    names = F.from_json(F.lit(json.dumps({n: entities.html5[n] for n in (*_NAMES, *_LEGACY)})), "map<string,string>")
    page = F.create_map(*[F.lit(x) for pair in PAGE.items() for x in pair])
    digits = F.regexp_replace(ref, r"^&#[xX]?|;$", "")
    hexed = ref.rlike("^&#[xX]")
    code = F.when(hexed, F.conv(digits, 16, 10)).otherwise(digits).cast("long")
    wrong = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    number = F.when(wrong, "\ufffd").otherwise(F.coalesce(F.try_element_at(page, code.cast("int")), plain))
    return F.when(F.substring(ref, 2, 1) == "#", number).otherwise(F.coalesce(F.try_element_at(names, F.substring(ref, 2, 40)), ref))


def unescaped(x: Column) -> Column:
    """A text with its character references, named or by number, decoded in one pass."""
    parts, refs = F.split(x, REFERENCE, -1), F.regexp_extract_all(x, F.lit(REFERENCE), F.lit(0))
    whole = F.array_join(F.zip_with(parts, F.transform(refs, _character), lambda p, c: F.concat(p, F.coalesce(c, F.lit("")))), "")
    return F.when(F.contains(x, F.lit("&")), whole).otherwise(x)


def html_to_text(x: Column) -> Column:
    """Text of a page: what stands between tags, scripts, styles and comments, each trimmed, the filled
    ones joined by a blank. A sign ``>`` in a quoted value ends no tag; a script, style or comment that
    is never closed takes the rest. A text without ``<`` is returned as it is.
    """
    nodes = F.split(unescaped(F.regexp_replace(x, _TAG, "\x01")), "\x01")
    filled = F.filter(F.transform(nodes, lambda n: F.regexp_replace(n, _EDGE_BLANKS, "")), lambda n: n != "")
    return F.when(F.instr(x, "<") > 0, F.array_join(filled, " ")).otherwise(x)


def truncate_words(x: Column, limit: int) -> Column:
    """Cut to ``limit`` characters with an ellipsis: at the last blank if that is beyond the middle, else hard."""
    head = F.substring(x, 1, limit - 1)
    blank = F.length(head) - F.instr(F.reverse(head), " ") + 1
    at_word = (F.instr(head, " ") > 0) & (blank - 1 > limit / 2)
    cut = F.rtrim(F.when(at_word, F.substring(head, F.lit(1), blank - 1)).otherwise(head), F.lit(BLANKS))
    return F.when(F.length(x) <= limit, x).otherwise(F.concat(cut, F.lit("…")))


def embed_text(title: Column, body: Column, role: str) -> Column:
    """Role, title, a blank line and the body, without those that are blank."""
    return F.concat(F.lit(f"{role}: "), F.concat_ws("\n\n", blank_to_null(title), blank_to_null(body)))


def spanish_date(x: Column) -> Column:
    """The first date like ``21 de julio de 2026``, null if that is no day; digits parted by one blank are joined first."""
    joined = F.regexp_replace(x, r"(?<=\d)\s(?=\d)", "")
    pattern = r"(?i)(\d{1,2})\s+de\s+(" + "|".join(MONTHS) + r")\s+de\s+(\d{4})"
    part = lambda k: F.nullif(F.regexp_extract(joined, pattern, k), F.lit(""))
    months = F.create_map(*[F.lit(v) for k, n in MONTHS.items() for v in (k, f"{n:02d}")])
    return F.to_date(F.try_to_timestamp(F.concat_ws("-", part(3), F.try_element_at(months, F.lower(part(2))), F.lpad(part(1), 2, "0")), F.lit("yyyy-MM-dd")))


def from_second(x: Column, *markers: str) -> Column:
    """Text from the second place, of all that hold any of the markers (the first if there is one only);
    white space in a marker is flexible; the whole text if there is none.
    """
    places = []
    for m in markers:
        p = F.lit("(?i)" + r"\s+".join(map(re.escape, m.split())))
        first, size = F.regexp_instr(x, p), F.length(F.regexp_substr(x, p))
        second = F.regexp_instr(F.substring(x, first + size, F.length(x)), p)
        places += [F.when(first > 0, first), F.when((first > 0) & (second > 0), first + size + second - 1)]
    found = F.array_sort(F.array_compact(F.array(*places)))
    return F.when(F.size(found) > 0, F.substring(x, F.coalesce(F.get(found, F.lit(1)), F.get(found, F.lit(0))), F.length(x))).otherwise(x)


def utc_text(at: Column) -> Column:
    """An instant in ISO form in UTC, whatever the session's zone; a fraction of a second shows if there is one."""
    seconds, micros = F.unix_seconds(at), F.pmod(F.unix_micros(at), F.lit(1_000_000))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))
    clock = F.pmod(seconds, F.lit(86400))
    two = lambda n: F.lpad(F.floor(n).cast("string"), 2, "0")
    fraction = F.when(micros > 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise("")
    return F.concat(day.cast("string"), F.lit("T"), F.concat_ws(":", two(clock / 3600), two(clock % 3600 / 60), two(clock % 60)), fraction, F.lit("+00:00"))


def guid(source: Column, url: Column, at: Column) -> Column:
    """SHA-256 of source, url and the UTC instant in ISO form."""
    return F.sha2(F.concat_ws("|", source, url, utc_text(at)), 256)


ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def iso_instant(x: Column) -> Column:
    """An ISO date or time; without zone it is UTC; anything else null."""
    t = strip(x)
    whole = F.when(F.length(t) == 10, F.concat(t, F.lit("T00:00:00Z"))).when(t.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & (F.length(t) > 10), t).otherwise(F.concat(t, F.lit("Z")))
    return F.when(t.rlike(ISO), F.try_to_timestamp(whole))


def dmy_value(date: Column, value: Column) -> tuple[Column, Column]:
    """dd/MM/yyyy and a number with thousands separators; what does not parse is null."""
    day = F.when(strip(date).rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.to_date(F.try_to_timestamp(strip(date), F.lit("d/M/yyyy"))))
    return day, F.replace(strip(value), F.lit(",")).try_cast("double")


def period_date(x: Column) -> Column:
    """yyyy, yyyy/mm or yyyy/mm/qq (fortnight 1 or 2) as its first day; anything else null."""
    ok = strip(x).rlike(r"^\d{4}(/\d{1,2}(/\d{1,2})?)?$")
    part = F.split(strip(x), "/")
    month = F.lpad(F.coalesce(F.get(part, F.lit(1)), F.lit("1")), 2, "0")
    half = F.get(part, F.lit(2)).cast("int")
    day = F.when(half.isNull() | (half == 1), "01").when(half == 2, "16")
    return F.when(ok, F.to_date(F.try_to_timestamp(F.concat_ws("-", F.get(part, F.lit(0)), month, F.coalesce(day, F.lit("xx"))), F.lit("yyyy-MM-dd"))))
