"""Column functions for cleaning text, dates, links and numbers. All are built-in expressions.

Missing and empty are kept apart: a function gives null for "not there" and '' only where its text says so.
"""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extracted(text: Column | str, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without a match."""
    return F.nullif(F.regexp_extract(_col(text), pattern, group), F.lit(""))


# The characters that count as white space at the ends of a text, in every script.
WHITE = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column | str) -> Column:
    """The text without white space of any script at its ends."""
    return F.trim(_col(text), F.lit(WHITE))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def or_default(c: Column | str, default) -> Column:
    return F.coalesce(_col(c), F.lit(default))


# ---- lists and keys


def list_text(items: Column | str, fields: tuple[str, ...] = ("label", "Name"), mode: str = "all") -> Column:
    """A list of structs as text: its labels joined by '; ', or with ``mode="first"`` the first one.

    An item is named by its first non-empty field, else by its JSON. A null list is '', an empty one '[]'.
    """
    items = _col(items)

    def name(x: Column) -> Column:
        return F.coalesce(*(F.nullif(x[f].cast("string"), F.lit("")) for f in fields), F.to_json(x))

    named = F.transform(items, name)
    text = F.array_join(named, "; ") if mode == "all" else F.coalesce(F.try_element_at(named, F.lit(1)), F.lit(""))
    return F.when(items.isNull(), "").when(F.size(items) == 0, "[]").otherwise(text)


def entity_url(key: Column | str, base: str) -> Column:
    """``base`` + key; null for an empty or missing key."""
    return F.when(or_empty(key) != "", F.concat(F.lit(base), _col(key).cast("string")))


def source_key(name: Column | str, folder: str) -> Column:
    return F.concat(F.lit(f"file://{folder}/"), _col(name))


# ---- links


def absolutise(href: Column | str, base: str) -> Column:
    """Puts ``base`` before a link that has no scheme; empty stays empty, null stays null."""
    href = _col(href)
    return F.when((href == "") | href.startswith("http"), href).otherwise(F.concat(F.lit(base), href))


def query_params(url: Column | str) -> Column:
    """Map of a link's parameters: first value of each key, decoded; keys without a value are left out."""
    pairs = F.filter(F.split(or_empty(F.try_parse_url(_col(url), F.lit("QUERY"))), "&"), lambda p: p.rlike("^[^=]+=.+"))
    keys = F.transform(pairs, lambda p: F.try_url_decode(F.regexp_extract(p, "^([^=]+)=", 1)))
    entries = F.transform(pairs, lambda p: F.struct(F.try_url_decode(F.regexp_extract(p, "^([^=]+)=", 1)).alias("k"), F.try_url_decode(F.regexp_extract(p, "^[^=]+=(.*)$", 1)).alias("v")))
    return F.map_from_entries(F.filter(entries, lambda e, i: F.array_position(keys, e["k"]) == i + 1))


def id_from_url(url: Column | str, key: str) -> Column:
    """Digits behind ``key=``."""
    return extracted(url, rf"{key}=(\d+)")


def url_path(url: Column | str) -> Column:
    return F.try_parse_url(_col(url), F.lit("PATH"))


def decoded(path: Column | str) -> Column:
    """Percent-decoding that leaves a plus sign alone."""
    return F.try_url_decode(F.replace(_col(path), F.lit("+"), F.lit("%2B")))


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def file_from_url(url: Column | str, title: Column | str, extension: str = ".mp3") -> Column:
    """The link's file name if it has the extension, else a slug of the title."""
    name = base_name(decoded(url_path(url)))
    return F.when(F.lower(name).endswith(extension), name).otherwise(F.concat(slug(title, keep_dot=True, max_len=150), F.lit(extension)))


# How a link to a recording stands in a page.
AUDIO = r"(https?://[^\"'\s<>]+\.mp3[^\"'\s<>]*)"


def audio_url(first: Column | str, second: Column | str, body: Column | str, pattern: str = AUDIO) -> Column:
    """The first of two fields that names an mp3, else one found in the body."""
    holds = lambda c: F.when(_col(c).contains(".mp3"), _col(c))
    return F.coalesce(holds(first), holds(second), extracted(or_empty(body), pattern))


# ---- numbers in text

_NUMBER = r"(?iU)^\s*[+-]?(\d+(_?\d)*\.?\d*|\.\d+)(e[+-]?\d+)?\s*$|^\s*[+-]?(inf(inity)?|nan)\s*$"


def is_number(text: Column | str) -> Column:
    """Whether a text reads as a floating point number."""
    return F.coalesce(_col(text).rlike(_NUMBER), F.lit(False))


def strip_commas(text: Column | str) -> Column:
    """Drops thousands commas if what is left is a number."""
    bare = F.replace(_col(text), F.lit(","), F.lit(""))
    return F.when(is_number(bare), bare).otherwise(_col(text))


def count_text(text: Column | str) -> Column:
    """A count without commas; empty or missing is '0'."""
    return F.when(or_empty(text) == "", "0").otherwise(strip(F.replace(_col(text), F.lit(","), F.lit(""))))


def fact_value(text: Column | str) -> Column:
    """A fact without its leading dollar sign and without any comma."""
    text = _col(text)
    return F.when(text.startswith("$"), F.translate(text, "$,", "")).otherwise(F.translate(text, ",", ""))


def start_year(label: Column | str) -> Column:
    """The first four of all digits, 0 with fewer."""
    digits = F.regexp_replace(_col(label), r"\D", "")
    return F.when(F.length(digits) >= 4, F.substring(digits, 1, 4).cast("int")).otherwise(0)


# ---- dates


def date_of(year: Column, month: Column, day: Column) -> Column:
    """A date from parts in text or numbers, null where there is no such day."""
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), month.cast("string"), day.cast("string"))
    return F.when(year.cast("int").between(1, 9999), text.try_cast("date"))


def padded2(text: Column) -> Column:
    """Zeros up to two characters; longer text is left as it is."""
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def mdy_iso(text: Column | str) -> Column:
    """month/day/year as ISO text by position, unchecked, parts without blanks around them; other text unchanged; null if there is none."""

    def iso(text: Column) -> Column:
        parts = F.split(text, "/")
        parts = F.when(text.rlike(r"\A\d+/\d+/\d+\z"), parts).otherwise(F.transform(parts, strip))  # most have no blanks to look for
        return let(parts, lambda p: F.when(F.size(p) == 3, F.concat_ws("-", p[2], padded2(p[0]), padded2(p[1]))).otherwise(F.nullif(text, F.lit(""))))

    return let(_col(text), iso)


def date_range(text: Column | str) -> Column:
    """struct(start, end) of 'a - b'. 'Present' ends with null; one part is a start; more than two are kept as start; an empty part is null."""
    text = _col(text)

    def ends(parts: Column) -> Column:
        last = F.try_element_at(parts, F.lit(2))
        start = F.when(F.size(parts) > 2, text).otherwise(mdy_iso(parts[0]))
        end = F.when((F.size(parts) == 2) & (F.lower(last) != "present"), mdy_iso(last))
        return F.struct(start.alias("start"), end.alias("end"))

    return let(F.transform(F.split(text, r"(?U)\s*-\s*"), strip), ends)


def pivot_year(year: Column | str) -> Column:
    """Two digits: below 50 belongs to 2000, the rest to 1900."""
    y = _col(year).cast("int")
    return F.when(y < 50, y + 2000).otherwise(y + 1900)


# The forms of dates in file names, in the order they are tried: (pattern, order of the groups, two-digit year).
FILE_DATES = (
    (r"\b(\d{1,2})[-.](\d{1,2})[-.](\d{4})\b", "mdy", False),
    (r"\b(\d{1,2})\.(\d{1,2})\.(\d{2})\b", "mdy", True),
    (r"\b(\d{1,2})-(\d{1,2})-(\d{2})\b", "mdy", True),
    (r"\b(\d{2})(\d{2})(\d{2})\b", "mdy", True),
    (r"\b(\d{2})(\d{2})(\d{4})\b", "mdy", False),
)
ISO_FILE_DATES = ((r"\b(\d{4})[-.](\d{2})[-.](\d{2})\b", "ymd", False),)


def file_date(stem: Column | str, patterns=FILE_DATES) -> Column:
    """struct(date, pattern): the first pattern whose first match is a real day, and its number from 1."""
    none = F.struct(F.lit(None).cast("date").alias("date"), F.lit(None).cast("int").alias("pattern"))

    def tried(name: Column, number: int, pattern: str, order: str, short: bool) -> Column:
        """The date of the first match, which is cut out once and then read by its groups."""

        def read(found: Column) -> Column:
            part = {c: F.regexp_extract(found, pattern, i) for i, c in enumerate(order, 1)}
            year = part["y"].cast("int")
            return F.when(found != "", date_of(pivot_year(year) if short else year, part["m"], part["d"]))

        return let(let(F.regexp_extract(name, pattern, 0), read), lambda date: F.when(date.isNotNull(), F.struct(date.alias("date"), F.lit(number).alias("pattern"))))

    return let(_col(stem), lambda name: F.coalesce(*(tried(name, i, *form) for i, form in enumerate(patterns, 1)), none))


# The date formats of the two page layouts.
PAGE_DATES_A = ("MMMM d, yyyy", "MMM. d, yyyy", "MMMM yyyy")
PAGE_DATES_B = ("MMMM d, yyyy", "MMM d, yyyy", "yyyy-M-d")


def text_date(text: Column | str, formats: tuple[str, ...] = PAGE_DATES_A) -> Column:
    """struct(date, raw): the first format that reads the text; ``raw`` is the ISO date, or the stripped text if none does.

    A blank of a format is any run of white space in the text.
    """
    def read(bare: Column) -> Column:
        date = let(F.regexp_replace(bare, r"(?U)\s+", " "), lambda even: F.coalesce(*(F.try_to_date(even, f) for f in formats)))
        return let(date, lambda d: F.struct(d.alias("date"), F.coalesce(F.date_format(d, "yyyy-MM-dd"), bare).alias("raw")))

    return let(strip(text), read)


# Prefixes of file names, in the order they are tried.
TITLE_PREFIXES = ("Kettering_Baptist_-_", "Kettering_Baptist_", "Kettering_Bap._", "Kettering_Bap_")


def file_title(stem: Column | str, date: Column | str, prefixes: tuple[str, ...] = TITLE_PREFIXES) -> Column:
    """A title from a file name that holds no date: without its prefix, with blanks for separators; null if nothing is left."""
    cases = "|".join("\\Q" + p + "\\E" for p in prefixes)
    bare = F.regexp_replace(_col(stem), f"^(?:{cases})", "") if prefixes else _col(stem)
    title = strip(F.regexp_replace(F.translate(bare, "_-", "  "), r"(?U)\s+", " "))
    return F.when(_col(date).isNull(), F.nullif(title, F.lit("")))


# ---- names


def slug(text: Column | str, keep_dot: bool = False, max_len: int | None = None) -> Column:
    """Letters, digits, underscores and hyphens (and dots) of any script; blanks become underscores."""
    kept = strip(F.regexp_replace(_col(text), r"(?U)[^\p{L}\p{N}_\s" + (r"\." if keep_dot else "") + r"-]", ""))
    name = F.regexp_replace(kept, r"(?U)\s+", "_")
    return F.substring(name, 1, max_len) if max_len else name


def dated_file_name(date: Column | str, title: Column | str) -> Column:
    return F.concat(or_default(date, "unknown"), F.lit("_"), slug(or_default(title, "untitled")), F.lit(".txt"))


def label_slug(label: Column | str) -> Column:
    """Dashes and slashes as hyphens, lower case."""
    return F.lower(strip(F.translate(_col(label), "–—/", "---")))


def drop_abbrev(name: Column | str) -> Column:
    """Without a parenthesis at the end."""
    return strip(F.regexp_replace(_col(name), r"\([^)]*\)$", ""))


def relabel(c: Column | str, names: dict[str, str]) -> Column:
    """Other names for some values."""
    c = _col(c)
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), c), c) if names else c


def percent_text(share: Column | str) -> Column:
    return F.concat(F.bround(_col(share) * 100, 0).cast("bigint").cast("string"), F.lit("%"))


def wrap(text: Column | str, width: int) -> Column:
    """Words in lines of fewer than ``width`` characters; a longer word has a line of its own."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("int").alias("used"))

    def add(acc: Column, w: Column) -> Column:
        fits = (acc["used"] > 0) & (acc["used"] + 1 + F.length(w) < width)
        gap = F.when(acc["used"] == 0, "").when(fits, " ").otherwise("\n")
        used = F.when(fits, acc["used"] + 1 + F.length(w)).otherwise(F.length(w))
        return F.struct(F.concat(acc["done"], gap, w).alias("done"), used.cast("int").alias("used"))

    words = F.filter(F.split(_col(text), r"(?U)\s+"), lambda w: w != "")
    return F.aggregate(words, start, add, lambda acc: acc["done"])


# ---- longer texts


def clean_transcript(text: Column | str) -> Column:
    """Drops speaker labels, brackets, stage directions, notes, hashed lines and a leading dash, and collapses blanks."""
    # What is dropped from a transcript, in this order.
    steps = (
        (r"Speaker \d+\s*:?\s*", ""),
        (r"(?s)\[.*?\]", ""),
        (r"(?s)\(.*?\)", ""),
        ("♪", ""),
        (r"#[^\n]*", ""),
        (r"^\s*[-–—]\s*", ""),
        (r"(?U)\s+", " "),
    )
    out = _col(text)
    for pattern, new in steps:
        out = F.regexp_replace(out, pattern, new)
    return strip(out)


def parse_move(text: Column | str, bold: Column | str) -> Column:
    """struct(name, to, from) of 'NAME, to PLACE, from PLACE', where ``bold`` is the name. A null name gives nulls."""

    def read(pair: Column) -> Column:
        text, bold = pair["text"], pair["bold"]
        at = F.instr(text, bold)
        rest = F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + F.length(bold), F.length(text)))).otherwise(text)
        return let(F.regexp_replace(strip(rest), r"(?U)^,\s*", ""), lambda rest: places(rest, bold))

    def places(rest: Column, bold: Column) -> Column:
        # Where the text of a move names its places.
        to, origin = r"(?U)^to\s+(.+?)(?:,\s*from\s+|$)", r"(?U)from\s+(.+)$"
        goes = lambda pattern: F.when(bold.isNotNull(), F.nullif(strip(F.regexp_extract(rest, pattern, 1)), F.lit("")))
        return F.struct(F.regexp_replace(bold, ",$", "").alias("name"), goes(to).alias("to"), goes(origin).alias("from"))

    return let(F.struct(_col(text).alias("text"), _col(bold).alias("bold")), read)


# Named character references that stand in escaped payloads; the ampersand comes last.
ENTITIES = (("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&"))


def unescape(text: Column | str) -> Column:
    """Decodes the usual character references; see ``unescape_all`` for every one."""
    out = _col(text)
    for name, char in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    return out


def _unescape_series(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else html.unescape(t))


def unescape_all(text: Column | str) -> Column:
    """Decodes every named and numeric character reference, in Arrow batches."""
    return F.pandas_udf(_unescape_series, "string")(_col(text))


# ---- survey values


def age(as_of: Column | int, birth_year: Column | str) -> Column:
    """Age in a fixed year or in the year of a column."""
    return (F.lit(as_of) if isinstance(as_of, int) else as_of) - _col(birth_year)


def bucket(value: Column | str, breaks: list[float], labels: list[str]) -> Column:
    """struct(label, ord) of the half-open bucket [break, next break) a value is in; the last one is open above."""
    value, out = _col(value), None
    for i, label in enumerate(labels):
        inside = value >= breaks[i]
        if i + 1 < len(breaks) and breaks[i + 1] != float("inf"):
            inside = inside & (value < breaks[i + 1])
        item = F.struct(F.lit(label).alias("label"), F.lit(i + 1).alias("ord"))
        out = F.when(inside, item) if out is None else out.when(inside, item)
    return out


AGE_BREAKS, AGE_LABELS = [18, 30, 45, 60, 75, float("inf")], ["18–29", "30–44", "45–59", "60–74", "75+"]


def period(year: Column | str, ranges: dict[str, tuple[int, int]]) -> Column:
    """The label of the first range of years that holds the value, else null."""
    year, out = _col(year), F.lit(None).cast("string")
    for label, (a, b) in reversed(ranges.items()):
        out = F.when(year.between(a, b), label).otherwise(out)
    return out


def clamp(value: Column | str, low, high) -> Column:
    """The value inside [low, high]; null stays null."""
    value = _col(value)
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def years_left(age_value: Column | str, end: int = 85, low: int = 18, high: int = 100) -> Column:
    """Years until ``end`` for a clamped age, not below 0."""
    kept = clamp(age_value, low, high)
    return F.when(kept.isNotNull(), F.greatest(F.lit(0), F.lit(end) - kept))


def cohort_flag(birth_year: Column | str, low: int = 1946, high: int = 1964) -> Column:
    """1 inside the cohort, else 0; null is 0."""
    return F.coalesce(F.when(_col(birth_year).between(low, high), 1).otherwise(0), F.lit(0))


def calendar_year(years: Column | str, as_of: int = 2024) -> Column:
    return F.lit(as_of) + _col(years)
