"""Normalisation of names, addresses, tags and price buckets as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwell.functions.text import (
    clamp_rating, collapse, ensure_list, isub, let, nfc, norm_text, strip, sub, title_case,
)

# ---- Fixed values: they decide the results and are given, not designed. ----------

TAXONOMY = {
    "american": "American", "burgers": "American", "hot dogs": "American",
    "bbq": "BBQ", "barbecue": "BBQ",
    "chinese": "Chinese", "szechuan": "Chinese", "cantonese": "Chinese",
    "japanese": "Japanese", "sushi": "Japanese", "ramen": "Japanese",
    "korean": "Korean", "thai": "Thai", "vietnamese": "Vietnamese", "pho": "Vietnamese",
    "indian": "Indian", "curry": "Indian",
    "italian": "Italian", "pizza": "Pizza", "pasta": "Italian", "french": "French",
    "greek": "Greek", "mediterranean": "Mediterranean", "spanish": "Spanish",
    "mexican": "Mexican", "tacos": "Mexican", "burritos": "Mexican",
    "latin": "Latin American", "caribbean": "Caribbean",
    "seafood": "Seafood", "vegetarian": "Vegetarian", "vegan": "Vegan", "halal": "Halal",
    "kosher": "Kosher", "breakfast": "Breakfast", "brunch": "Breakfast",
    "desserts": "Desserts", "bakery": "Bakery", "cafe": "Cafe", "coffee": "Cafe",
    "healthy": "Healthy", "salads": "Healthy", "sandwiches": "Sandwiches", "subs": "Sandwiches",
    "wings": "Wings", "chicken": "Chicken", "fast food": "Fast Food",
}

PRICE_BUCKETS = {
    "$": "$", "1": "$", "low": "$",
    "$$": "$$", "2": "$$", "mid": "$$", "medium": "$$",
    "$$$": "$$$", "3": "$$$", "high": "$$$",
    "$$$$": "$$$$", "4": "$$$$", "expensive": "$$$$",
}

LOCATIONS = [
    "amsterdam", "centrum", "oost", "west", "noord", "zuid", "de pijp", "jordaan",
    "westerpark", "zuidas", "ndsm", "diemen", "amstelveen", "badhoevedorp", "duivendrecht",
    "ijburg", "zuidoost", "bijlmerplein", "osdorp",
]

SLOGAN_MARKS = ["beste", "best", "new!", "nieuw", "order"]

PLATFORM_TAIL = (
    r"\s*[-–—]\s*(order (online|now|delivery)|delivery|menu|doordash|grubhub"
    r"|uber\s?eats|thuisbezorgd|just\s?eat).*$"
)
PAREN_TAIL = r"\s*\((doordash|grubhub|uber\s?eats|thuisbezorgd|just\s?eat|[^)]{1,30})\)\s*$"
BRANCH_TAIL = r"\s*[-–—]\s+[A-Z][\w\s'./-]*$"

ADDRESS_WORDS = [
    (r"\bSt\b\.?", "Street"),
    (r"\bStraat\b", "Street"),
    (r"\bAve\b\.?", "Avenue"),
    (r"\bBlvd\b\.?", "Boulevard"),
    (r"\bDr\b\.?", "Drive"),
    (r"\bLn\b\.?", "Lane"),
    (r"\bLaan\b", "Lane"),
    (r"\bCt\b\.?", "Court"),
    (r"\bPl\b\.?", "Place"),
    (r"\bPlein\b", "Square"),
    (r"\bRd\b\.?", "Road"),
    (r"\bWeg\b", "Road"),
    (r"\bSte\b\.?", "Suite"),
    (r"\bApt\b\.?", "Apartment"),
    (r"\bFl\b\.?", "Floor"),
]
POSTAL_GAP = r"\b(\d{4})\s*([A-Z]{2})\b"

# ---- End of fixed values. ---------------------------------------------------------


def _literal_map(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def _before_pipe(name: Column) -> Column:
    """First part between pipes that is neither a place nor a slogan, else the first part.

    A name without a pipe has one part, which comes back unchanged either way.
    """

    def telling(part: Column) -> Column:
        low = F.lower(part)
        slogan = reduce(lambda a, b: a | b, [low.contains(m) for m in SLOGAN_MARKS])
        return ~low.isin(LOCATIONS) & ~slogan

    return let(
        F.transform(F.split(name, r" \| "), strip),
        lambda parts: F.element_at(F.concat(F.filter(parts, telling), F.slice(parts, 1, 1)), 1),
    )


def _drop_repeats(name: Column) -> Column:
    """Drop a word equal, letter case aside, to the word before it."""
    return let(
        F.split(collapse(name), " "),
        lambda words: F.array_join(
            F.filter(
                words,
                lambda w, i: (i == 0) | (F.lower(w) != F.lower(F.get(words, i - 1))),
            ),
            " ",
        ),
    )


def normalize_name(c: Column) -> Column:
    name = collapse(nfc(c))
    name = isub(isub(name, PLATFORM_TAIL, ""), PAREN_TAIL, "")
    name = _before_pipe(F.regexp_replace(name, " [Il] ", " | "))
    name = sub(name, BRANCH_TAIL, "")
    for place in LOCATIONS:  # once each, in this order
        name = isub(name, rf"\s+{place}\s*$", "")
    return _drop_repeats(name)


def normalize_address(c: Column) -> Column:
    text = collapse(nfc(F.coalesce(c, F.lit(""))))
    for pattern, word in ADDRESS_WORDS:
        text = isub(text, pattern, word)
    return isub(text, POSTAL_GAP, "$1 $2")


def normalize_cuisine_tags(c: Column, compat: bool = False) -> Column:
    """Tags mapped to the taxonomy, others title-cased, repeats dropped in order.

    The stored value decides what a repeat is. ``compat`` looks an unmapped tag up by its
    raw text instead, so ``vegan bowls`` twice stays twice.
    """
    taxonomy = _literal_map(TAXONOMY)

    def entry(tag: Column) -> Column:
        bare = strip(tag)
        known = F.element_at(taxonomy, F.lower(bare))
        return F.struct(
            F.coalesce(known, title_case(bare)).alias("stored"),
            F.coalesce(known, bare).alias("probe") if compat else F.coalesce(known, title_case(bare)).alias("probe"),
        )

    entries = F.filter(F.transform(c, entry), lambda e: e["stored"] != "")
    kept = F.aggregate(
        entries,
        F.array().cast("array<string>"),
        lambda acc, e: F.when(F.array_contains(acc, e["probe"]), acc).otherwise(F.concat(acc, F.array(e["stored"]))),
    )
    return F.coalesce(kept, F.array().cast("array<string>"))


def normalize_price_bucket(c: Column) -> Column:
    bare = strip(c)
    return F.when(c != "", F.coalesce(F.element_at(_literal_map(PRICE_BUCKETS), F.lower(bare)), bare))


def normalize_listings(df: DataFrame) -> DataFrame:
    """All four normalisations in one projection."""
    return df.withColumns(
        {
            "name": normalize_name(F.col("name")),
            "address": normalize_address(F.col("address")),
            "cuisine_tags": normalize_cuisine_tags(F.col("cuisine_tags")),
            "price_bucket": normalize_price_bucket(F.col("price_bucket")),
        }
    )


def validate_listings(df: DataFrame) -> DataFrame:
    """Row rules of the listing model: rating in 0..5 and tags as a list."""
    tags = F.col("cuisine_tags")
    if df.schema["cuisine_tags"].dataType.typeName() == "string":
        tags = ensure_list(tags)
    else:
        tags = F.coalesce(tags, F.array().cast("array<string>"))
    return df.withColumns({"rating": clamp_rating(F.col("rating")), "cuisine_tags": tags})


def extract_restaurant_name(c: Column) -> Column:
    return norm_text(normalize_name(F.coalesce(c, F.lit(""))))


def extract_address_fields(c: Column) -> Column:
    """Struct of ``street_number``, ``street_name`` and ``city``.

    A four-digit run counts as a postal code wherever it stands, and splits the text into
    street part and city part; without one the last comma does.
    """
    postal = r"(?iU)\b(\d{4})\s*([A-Z]{2})?\b"
    edges = r"^[ ,]+|[ ,]+$"

    def around_postal(a: Column) -> Column:
        at = F.regexp_instr(a, F.lit(postal))
        hit = F.regexp_extract(a, postal, 0)
        after = F.regexp_replace(a.substr(at + F.length(hit), F.length(a)), edges, "")
        before = F.regexp_replace(a.substr(F.lit(1), at - 1), edges, "")
        return F.struct(before.alias("street"), strip(F.get(F.split(after, ","), F.lit(0))).alias("city"))

    def around_comma(a: Column) -> Column:
        parts = F.transform(F.split(a, ","), strip)
        several = F.size(parts) >= 2
        head = F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), ",")
        return F.struct(
            F.when(several, head).otherwise(a).alias("street"),
            F.when(several, F.element_at(parts, -1)).otherwise("").alias("city"),
        )

    def fields(half: Column) -> Column:
        street = half["street"]
        number = r"(?U)\b(\d+[a-zA-Z]?)\b"
        at = F.regexp_instr(street, F.lit(number))
        hit = F.regexp_extract(street, number, 0)
        rest = F.when(
            at > 0,
            strip(
                F.concat(
                    strip(street.substr(F.lit(1), at - 1)), F.lit(" "),
                    strip(street.substr(at + F.length(hit), F.length(street))),
                )
            ),
        ).otherwise(street)
        return F.struct(
            F.lower(hit).alias("street_number"),
            F.regexp_replace(sub(rest, r"\s+", " "), r"^[ ,\-]+|[ ,\-]+$", "").alias("street_name"),
            half["city"].alias("city"),
        )

    address = norm_text(normalize_address(c))
    return let(
        address,
        lambda a: let(F.when(a.rlike(postal), around_postal(a)).otherwise(around_comma(a)), fields),
    )
