"""Text and number coercion as column expressions.

Python's ``strip``, ``\\s``, ``\\d`` and ``\\b`` are Unicode-aware, so every pattern here
carries Java's ``(?U)`` flag; Spark's own ``trim`` removes spaces only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four separators Python also counts as space.
WS = r"[\s\x1c-\x1f]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sub(c: Column, pattern: str, repl: str) -> Column:
    return F.regexp_replace(c, f"(?U){pattern}", repl)


def isub(c: Column, pattern: str, repl: str) -> Column:
    """Case-insensitive replace."""
    return F.regexp_replace(c, f"(?iU){pattern}", repl)


def strip(c: Column) -> Column:
    return sub(c, f"^{WS}+|{WS}+$", "")


def collapse(c: Column) -> Column:
    """Strip, then one space for each run of white space."""
    return sub(strip(c), f"{WS}+", " ")


def norm_text(c: Column) -> Column:
    """Lower case, stripped, collapsed; null becomes empty."""
    return F.lower(collapse(F.coalesce(c, F.lit(""))))


def nfc(c: Column) -> Column:
    """Canonical composition (Unicode NFC).

    Spark has no function for it, but ships ICU for its collations; calling that keeps
    the work in the JVM. CASE is lazy, so pure-ASCII values never reach the call.
    """
    composed = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))
    return F.when(c.rlike(r"[^\x00-\x7F]"), composed).otherwise(c)


def safe_float(c: Column) -> Column:
    """Text to double after dropping all but digits and dots (so also a minus sign)."""
    return F.regexp_replace(c, r"(?U)[^\d.]", "").try_cast("double")


def safe_coord(c: Column) -> Column:
    """Like :func:`safe_float`, but a leading minus survives: coordinates need it."""
    return F.regexp_replace(c, r"(?U)[^\d.\-]", "").try_cast("double")


def safe_int(c: Column) -> Column:
    """Text to bigint after dropping all but digits."""
    return F.regexp_replace(c, r"(?U)\D", "").try_cast("bigint")


def truncate_int(c: Column) -> Column:
    """Number to bigint, fraction cut off."""
    return c.cast("bigint")


def coerce_price(c: Column) -> Column:
    """Price text without ``$`` and ``,``; empty or unreadable text is null."""
    return strip(F.translate(c, "$,", "")).try_cast("double")


def price_rejected(c: Column) -> Column:
    """True where a price text is there but cannot be read."""
    bare = strip(F.translate(c, "$,", ""))
    return F.coalesce((bare != "") & bare.try_cast("double").isNull(), F.lit(False))


def clamp_rating(c: Column) -> Column:
    """Into 0..5; null stays null (greatest/least alone would skip it)."""
    v = c.cast("double")
    return F.when(v.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(5.0), v)))


def ensure_list(c: Column) -> Column:
    """Comma text to an array of stripped non-empty parts; null to an empty array."""
    parts = F.transform(F.split(c, ","), strip)
    return F.coalesce(F.filter(parts, lambda x: x != ""), F.array().cast("array<string>"))


def null_or_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def null_or_empty(c: Column) -> Column:
    return c.isNull() | (c == "")


def null_or_empty_array(c: Column, pg_compat: bool = False) -> Column:
    """With ``pg_compat`` an empty array does not count as missing."""
    return c.isNull() if pg_compat else c.isNull() | (F.size(c) == 0)


def looks_like_address(c: Column) -> Column:
    """At least 8 characters, and a Dutch postal code or both a comma and a digit."""
    t = collapse(F.coalesce(c, F.lit("")))
    return (F.length(t) >= 8) & (
        t.rlike(r"(?U)\b\d{4}\s?[A-Z]{2}\b") | (t.contains(",") & t.rlike(r"(?U)\d"))
    )


def title_case(c: Column) -> Column:
    """Upper case after every non-letter, lower case elsewhere (``Joe'S``)."""
    pieces = F.split(F.lower(c), r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))),
        "",
    )


def unescape_state(c: Column) -> Column:
    """Undo one level of quoting around JSON kept in a script tag."""
    quoted = F.replace(F.replace(c, F.lit("\\u0022"), F.lit('"')), F.lit('\\"'), F.lit('"'))
    return F.regexp_replace(quoted, r'(?s)^"(.*)"$', "$1")


def shortest(texts: Column) -> Column:
    """Shortest text of an array, the first on a tie; null for an empty array."""
    ranked = F.transform(
        texts, lambda t, i: F.struct(F.length(t).alias("n"), i.alias("pos"), t.alias("text"))
    )
    return F.array_min(ranked)["text"]


def rating_in_label(label: Column) -> Column:
    """``Rating 4,6 of 5`` to 4.6."""
    hit = F.regexp_extract(label, r"(?U)(\d[.,]\d)", 1)
    return safe_float(F.replace(hit, F.lit(","), F.lit(".")))


def reviews_in_label(label: Column) -> Column:
    """``based on 1.234 reviews`` to 1234."""
    hit = F.regexp_extract(
        label, r"(?iU)(\d+[\d\s,.]*)\s*(?:reviews|recensies|ratings|waarderingen)", 1
    )
    return safe_int(hit)
