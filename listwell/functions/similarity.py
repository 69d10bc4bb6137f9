"""Fuzzy text scores (0..100) and distance measures.

Only the longest-common-subsequence core lacks a built-in; it runs as an Arrow UDF.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from listwell.functions.text import norm_text

# Workers get these helpers with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EARTH_RADIUS_M = 6371008.8  # fixed value: mean radius


def letter_masks(a: str) -> dict[str, int]:
    """For each letter the positions it stands on, as bits."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | 1 << i
    return masks


def lcs_length(a: str, b: str, known: dict | None = None) -> int:
    """Length of the longest common subsequence, one big-integer step per character.

    ``known`` keeps the masks of texts already seen.
    """
    if known is None:
        masks = letter_masks(a)
    else:
        masks = known.get(a)
        if masks is None:
            masks = known[a] = letter_masks(a)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        if u:
            v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def _ratio(a: str, b: str, known: dict | None = None) -> float:
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * lcs_length(a, b, known) / total


def _token_set_ratio(a: str, b: str, known: dict | None = None) -> float:
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    common = ta & tb
    if common and (ta <= tb or tb <= ta):
        return 100.0
    x, y = " ".join(sorted(ta - tb)), " ".join(sorted(tb - ta))
    s = len(" ".join(common))
    gap = 1 if s else 0
    p, q = s + gap + len(x), s + gap + len(y)
    best = 100.0 - 100.0 * (len(x) + len(y) - 2 * lcs_length(x, y, known)) / (p + q)
    if s:
        best = max(best, 100.0 - 100.0 * (gap + len(x)) / (s + p), 100.0 - 100.0 * (gap + len(y)) / (s + q))
    return best


def _fuzz(a: str, b: str, known: dict | None = None) -> float:
    if not a or not b or a == b:
        return 100.0 if a == b else 0.0
    if a.split() == [a] and b.split() == [b]:  # single words: both ratios are the same
        return _ratio(a, b, known)
    return max(_ratio(a, b, known), _token_set_ratio(a, b, known))


def _pairwise(score):
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict = {}
        return pd.Series([score(x or "", y or "", known) for x, y in zip(a, b)], dtype="float64")

    return run


def ratio(a: Column, b: Column) -> Column:
    """200 * LCS / (len a + len b)."""
    return _pairwise(_ratio)(a, b)


def token_set_ratio(a: Column, b: Column) -> Column:
    return _pairwise(_token_set_ratio)(a, b)


def fuzz_score(a: Column, b: Column) -> Column:
    """Better of the two ratios; both empty 100, one empty 0."""
    return _pairwise(_fuzz)(a, b)


def name_similarity(a: Column, b: Column) -> Column:
    return fuzz_score(norm_text(a), norm_text(b)) / 100.0


def geo_distance_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in metres; null if any coordinate is null."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(
        F.sin((F.radians(lng2) - F.radians(lng1)) / 2), 2
    )
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))


def score_match(name_sim: Column, distance_m: Column, address_match: Column) -> Column:
    """Name score, raised for an equal address, lowered by distance, kept in 0..1."""
    base = F.when(address_match & (name_sim >= 0.9), F.least(F.lit(1.0), name_sim + 0.1)).otherwise(name_sim)
    near = F.when(distance_m.isNotNull(), 1 - F.least(distance_m / 400.0, F.lit(0.5))).otherwise(1.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), base * near))


def quality_score(rating: Column, reviews: Column, natural: bool = False) -> Column:
    """Rating weighted by the logarithm of the review count (base 10, or natural)."""
    log = F.ln if natural else F.log10
    return F.coalesce(rating.cast("double"), F.lit(0.0)) * log(F.coalesce(reviews, F.lit(1)) + F.lit(1))


def geo_valid(lat: Column, lng: Column) -> Column:
    ok = lat.isNotNull() & lng.isNotNull() & ~F.isnan(lat) & ~F.isnan(lng)
    return F.coalesce(ok & lat.between(-90, 90) & lng.between(-180, 180), F.lit(False))


def geo_point(lat: Column, lng: Column) -> Column:
    """``SRID=4326;POINT(lng lat)`` where both are there and neither is 0."""
    usable = (lat != 0) & (lng != 0) & ~F.isnan(lat) & ~F.isnan(lng)
    return F.when(usable, F.concat(F.lit("SRID=4326;POINT("), lng.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")")))


def week_bucket(ts: Column) -> Column:
    """Monday the week starts on."""
    return F.date_trunc("week", ts)
