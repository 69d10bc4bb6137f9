"""Entity resolution: which listings of different platforms are the same merchant.

Listings are reduced to *signatures*: distinct (market, name, street number, street, city)
after normalisation. Copies of a listing, however many, are one signature. All fuzzy
work is on signatures and on dictionaries of distinct field values.

An address field counts only where both sides have it. Each signature therefore emits
address keys: on the left, for each field, either a value similar to its own or the
mark for "other side has none" (own field empty: the mark for "any"); on the right, its
own value and the mark for "any". Equal keys then mean that the addresses agree, so one
equi-join on (market, name, address keys) yields matches only and needs no further test.

Clusters do not need the pairs. Left and right rows under one key all match each other
as far as platforms allow, so both sides are tied to a node that stands for the key.
The edges grow with the signatures, not with the pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwell.functions.normalize import extract_address_fields, extract_restaurant_name
from listwell.functions.similarity import fuzz_score, geo_point
from listwell.operators.components import connected_components
from listwell.operators.fuzzy import THRESHOLD, similar_pairs
from listwell.operators.tables import reset_resolution
from listwell.plans.coverage import OWN_PLATFORM
from listwell.plans.quality import market_mode
from listwell.session import cut_lineage, spread

PARTS = ("street_number", "street_name", "city")
SIGNATURE = ("market", "name", *PARTS)
KEYS = ("k_number", "k_street", "k_city")
KEY_OF = dict(zip(PARTS, KEYS))
ANY, NONE = "\u0001any", ""
SEVERAL = "\u0001several"

Sides = tuple[DataFrame, DataFrame]


def merchants_scan(pm: DataFrame, market: str | None = None) -> DataFrame:
    """The seven columns matching reads: rows with a name, or all rows of one market."""
    cols = pm.select("id", "platform", "name", "address", "lat", "lng", "market")
    return cols.where(F.col("market") == market) if market is not None else cols.where(F.col("name").isNotNull())


def match_fields(pm: DataFrame) -> DataFrame:
    """Cleaned name and address fields, once per row."""
    return pm.select(
        "id", "platform", "market",
        extract_restaurant_name(F.col("name")).alias("name"),
        extract_address_fields(F.col("address")).alias("address"),
    ).select("id", "platform", "market", "name", *[f"address.{p}" for p in PARTS])


def fill_market(pm: DataFrame) -> DataFrame:
    """Unknown markets become the most frequent one."""
    mode = market_mode(pm).select(F.col("market").alias("usual_market"))
    return pm.crossJoin(F.broadcast(mode)).withColumn("market", F.coalesce("market", "usual_market")).drop("usual_market")


def in_mixed_markets(fields: DataFrame) -> DataFrame:
    """Rows of markets in which at least two platforms are present."""
    mixed = fields.groupBy("market").agg(F.count_distinct("platform").alias("n")).where("n >= 2")
    return fields.join(mixed, "market", "left_semi")


def signatures(fields: DataFrame) -> DataFrame:
    """Distinct signatures: ``sid`` is the least listing id, ``side`` the platform if it is the only one."""
    return (
        fields.groupBy(*SIGNATURE)
        .agg(F.min("id").alias("sid"), F.min("platform").alias("p0"), F.max("platform").alias("p1"))
        .select("sid", *SIGNATURE, F.when(F.col("p0") == F.col("p1"), F.col("p0")).otherwise(SEVERAL).alias("side"))
    )


def own_keys(sigs: DataFrame, parts: tuple[str, ...]) -> DataFrame:
    """Right side: for each field its own value and the mark for "any"."""
    out = sigs
    for part in parts:
        out = out.withColumn(KEY_OF[part], F.explode(F.array(F.col(part), F.lit(ANY))))
    return out


def partner_keys(sigs: DataFrame, similar: DataFrame, parts: tuple[str, ...]) -> DataFrame:
    """Left side: for each field every key of its value, with the score of the two values."""
    out = sigs
    for part in parts:
        key = KEY_OF[part]
        own = similar.where(F.col("part") == part).select(
            "market", F.col("value").alias(part), F.col("key").alias(key), F.col("score").alias(f"{key}_score")
        )
        out = out.join(own, ["market", part])
    return out


def partners(sigs: DataFrame, parts: tuple[str, ...], near: DataFrame) -> DataFrame:
    """(part, market, value, key, score): every key a field value emits on the left side.

    ``near`` holds the similar pairs (part, market, value_a, value_b, score).
    """
    fields = F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).alias("value")) for p in parts])
    values = sigs.select("market", F.inline(fields)).distinct()
    row = lambda value, key, score: F.struct(
        value.alias("value"), key.alias("key"), score.cast("double").alias("score")
    )
    value = F.col("value")
    alone = F.when(
        value != "", F.array(row(value, value, F.lit(100.0)), row(value, F.lit(NONE), F.lit(None)))
    ).otherwise(F.array(row(value, F.lit(ANY), F.lit(None))))
    a, b = F.col("value_a"), F.col("value_b")
    both = F.array(row(a, b, F.col("score")), row(b, a, F.col("score")))
    return values.select("part", "market", F.inline(alone)).unionByName(near.select("part", "market", F.inline(both)))


def _similar_in_market(column: str, left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(market, value_a, value_b, score): similar values of a column that occur under equal keys."""

    def under_keys(side: DataFrame) -> DataFrame:
        return side.select("market", *keys, F.col(column).alias("value")).where("value <> ''").distinct()

    return similar_pairs(under_keys(left), under_keys(right), ["market", *keys], ["market"])


def _address_partners(sigs: DataFrame) -> DataFrame:
    """Keys of all three fields: numbers and cities per market, then streets under agreeing numbers."""
    first = ("street_number", "city")
    fields = F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).alias("value")) for p in first])
    values = sigs.select("market", F.inline(fields)).where("value <> ''").distinct()
    near = similar_pairs(values, values, ["market", "part"], ["market", "part"])
    short = cut_lineage(partners(sigs, first, near))
    numbers = ("street_number",)
    streets = _similar_in_market(
        "street_name", partner_keys(sigs, short, numbers), own_keys(sigs, numbers), [KEY_OF["street_number"]]
    ).withColumn("part", F.lit("street_name"))
    return short.unionByName(partners(sigs, ("street_name",), streets))


def _name_partners(sigs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(market, name, other, name_score): similar names under agreeing addresses, each with itself too."""
    near = _similar_in_market("name", left, right, list(KEYS)).select(
        "market", F.col("value_a").alias("name"), F.col("value_b").alias("other"), F.col("score").alias("name_score")
    )
    names = sigs.select("market", "name").distinct()
    return near.unionByName(names.select("market", "name", F.col("name").alias("other"), F.lit(100.0).alias("name_score")))


def matching_sides(sigs: DataFrame) -> Sides:
    """Left and right rows whose equal (market, other, keys) means a match."""
    right = own_keys(sigs, PARTS).select("sid", "side", "market", "name", *KEYS)
    # Most combinations of similar values exist nowhere; they go before names are looked at.
    there = right.select("market", *KEYS).distinct()
    keyed = partner_keys(sigs, cut_lineage(_address_partners(sigs)), PARTS)
    left = keyed.select("sid", "side", "market", "name", *KEYS, *[f"{k}_score" for k in KEYS])
    left = cut_lineage(left.join(there, ["market", *KEYS], "left_semi"))
    names = cut_lineage(_name_partners(sigs, left, right))
    return left.join(names, ["market", "name"]), right.withColumnRenamed("name", "other")


JOIN_KEYS = ["market", "other", *KEYS]


def _confidence(name_score: Column, scores: list[Column]) -> Column:
    """Mean of the name score and of the address scores that exist, as 0..1."""
    total = reduce(lambda a, b: a + b, [F.coalesce(s, F.lit(0.0)) for s in scores], name_score)
    used = reduce(lambda a, b: a + b, [s.isNotNull().cast("int") for s in scores], F.lit(1))
    return total / used / 100.0


def match_signatures(sides: Sides) -> DataFrame:
    """(sid_a, sid_b, name_similarity, confidence): each pair of matching signatures once.

    A signature is paired with itself too: its listings on different platforms match. Two of one and
    the same single platform are not paired.
    """
    left, right = sides
    r = right.select(*JOIN_KEYS, F.col("sid").alias("sid_b"), F.col("side").alias("side_b"))
    return (
        left.withColumnRenamed("sid", "sid_a")
        .join(r, JOIN_KEYS)
        .where((F.col("name") != F.col("other")) | (F.col("sid_a") <= F.col("sid_b")))
        .where((F.col("side") != F.col("side_b")) | (F.col("side") == SEVERAL))
        .select(
            "sid_a", "sid_b", (F.col("name_score") / 100.0).alias("name_similarity"),
            _confidence(F.col("name_score"), [F.col(f"{k}_score") for k in KEYS]).alias("confidence"),
        )
    )


def _resolvable(pm: DataFrame) -> DataFrame:
    return in_mixed_markets(match_fields(spread(fill_market(pm), "id")))


#: Listings of a signature are dealt into heaps of about so many; pairs are made heap by heap.
HEAP = 512


def rule_based_match(pm: DataFrame, digits: int | None = None) -> DataFrame:
    """Every pair of matching listings, as the row-level report; scores rounded to ``digits``, if given.

    The report is as long as there are pairs. Clustering does not go through it. What there is to say of a
    pair of signatures is worked out, and rounded, once and not for each of its pairs of listings. A heap of
    listings meets each heap of a partner on its own, so that one signature with many listings is many tasks.
    """
    fields = cut_lineage(_resolvable(pm))
    sigs = cut_lineage(signatures(fields))
    listed = fields.join(sigs, list(SIGNATURE)).select("sid", "id", "platform").join(pm.select("id", F.col("name").alias("shown")), "id")
    heaps = listed.groupBy("sid").agg(F.ceil(F.count("*") / HEAP).alias("heaps"))
    listed = cut_lineage(listed.join(heaps, "sid").withColumn("heap", F.pmod(F.xxhash64("id"), F.col("heaps"))).drop("heaps"))
    used = cut_lineage(listed.select("sid", "heap").distinct())
    of = lambda rows, s: rows.toDF(*[f"{c}_{s}" for c in rows.columns])
    matched = match_signatures(matching_sides(sigs))
    if digits is not None:
        matched = matched.withColumns({c: F.round(c, digits) for c in ("name_similarity", "confidence")})
    pairs = (
        matched.join(of(used, "a"), "sid_a").join(of(used, "b"), "sid_b")
        .join(of(listed, "a"), ["sid_a", "heap_a"])
        .join(of(listed, "b"), ["sid_b", "heap_b"])
        .where("platform_a <> platform_b AND (sid_a <> sid_b OR id_a < id_b)")
    )
    ordered = F.col("id_a") < F.col("id_b")
    first, second = (lambda a, b: F.when(ordered, F.col(a)).otherwise(F.col(b))), (lambda a, b: F.when(ordered, F.col(b)).otherwise(F.col(a)))
    return pairs.select(
        first("id_a", "id_b").alias("id_a"), second("id_a", "id_b").alias("id_b"), first("shown_a", "shown_b").alias("name_a"),
        second("shown_a", "shown_b").alias("name_b"), "name_similarity", F.lit(None).cast("double").alias("geo_distance_m"),
        F.lit(True).alias("address_match"), "confidence", F.lit("field_fuzzy").alias("match_method"),
    )


def key_edges(sides: Sides) -> DataFrame:
    """Edges (src, dst) that tie together what matches, one per signature and key.

    Signatures of one single platform do not match each other, so a key stands for
    one node per ``side`` on its right; a left row joins those of other sides.
    """
    left, right = sides
    r_sides = right.select(*JOIN_KEYS, F.col("side").alias("r_side")).distinct()
    node = [*JOIN_KEYS, "r_side"]
    differ = (F.col("side") != F.col("r_side")) | (F.col("side") == SEVERAL)
    from_left = left.select(*JOIN_KEYS, "side", "sid").join(r_sides, JOIN_KEYS).where(differ)
    from_right = right.withColumnRenamed("side", "r_side").join(from_left.select(*node).distinct(), node, "left_semi")
    tied = from_right.select(*node, "sid").unionByName(from_left.select(*node, "sid")).distinct()
    least = tied.groupBy(*node).agg(F.min("sid").alias("low"))
    # A signature on several platforms is an entity even if it is alone under its key.
    return tied.join(least, node).select(F.col("sid").alias("src"), F.col("low").alias("dst")).distinct()


def members_of(fields: DataFrame, sigs: DataFrame, sides: Sides) -> DataFrame:
    labels = connected_components(key_edges(sides))
    named = sigs.join(labels.select(F.col("member_id").alias("sid"), "entity_id"), "sid")
    members = fields.join(named.select(*SIGNATURE, "sid", "entity_id"), list(SIGNATURE))
    return cut_lineage(members.select("entity_id", "id", "platform", "sid"))


def cluster_listings(pm: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entity_id, id, platform, sid) of all matched listings, and the signatures used."""
    fields = cut_lineage(_resolvable(pm))
    sigs = cut_lineage(signatures(fields))
    return members_of(fields, sigs, matching_sides(sigs)), sigs


def _listing_pairs(fields: DataFrame, sigs: DataFrame, sides: Sides) -> DataFrame:
    """Number of matching listing pairs in one row, without forming them.

    Each matching pair of signatures contributes the product of its listings, less the
    products on equal platforms.
    """
    counted = fields.groupBy(*SIGNATURE, "platform").agg(F.count("*").alias("n"))
    sizes = counted.join(sigs, list(SIGNATURE)).select("sid", "platform", "n")
    size = lambda s: sizes.select(F.col("sid").alias(f"sid_{s}"), F.col("platform").alias(f"platform_{s}"), F.col("n").alias(f"n_{s}"))
    return (
        match_signatures(sides).select("sid_a", "sid_b").join(size("a"), "sid_a").join(size("b"), "sid_b")
        .where("platform_a <> platform_b AND (sid_a <> sid_b OR platform_a < platform_b)")
        .agg(F.coalesce(F.sum(F.col("n_a").cast("decimal(19,0)") * F.col("n_b").cast("decimal(19,0)")).cast("bigint"), F.lit(0)).alias("pairs"))
    )


def pair_count(pm: DataFrame) -> DataFrame:
    fields = cut_lineage(_resolvable(pm))
    sigs = cut_lineage(signatures(fields))
    return _listing_pairs(fields, sigs, matching_sides(sigs))


def pair_lookup(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """Confidence of the pair (member, entity root) in either direction, 1 where there is none."""
    keyed = pairs.select(
        F.least("id_a", "id_b").alias("low"), F.greatest("id_a", "id_b").alias("high"), "confidence", "match_method"
    )
    ends = members.withColumns({"low": F.least("id", "entity_id"), "high": F.greatest("id", "entity_id")})
    return ends.join(keyed, ["low", "high"], "left").select(
        "entity_id", "id", F.coalesce("confidence", F.lit(1.0)).alias("confidence"),
        F.coalesce("match_method", F.lit("cluster_member")).alias("match_method"),
    )


def comparable_pairs(pm: DataFrame) -> DataFrame:
    """Per market: how many pairs of different platforms a row-by-row matcher would compare.

    Counted from the platform sizes; no pair is formed.
    """
    sizes, n = pm.groupBy("market", "platform").agg(F.count("*").alias("n")), F.col("n").cast("decimal(14,0)")
    return sizes.groupBy("market").agg(
        F.count("*").alias("platforms"), F.sum("n").cast("decimal(19,0)").alias("all"), F.sum(n * n).alias("within")
    ).where("platforms >= 2").select("market", "platforms", ((F.col("all") * F.col("all") - F.col("within")) / 2).cast("decimal(38,0)").alias("pairs"))


def _agreement(a: str, b: str) -> tuple[Column, Column]:
    """(do the two signatures match, with what confidence) for columns prefixed ``a`` and ``b``."""
    name = fuzz_score(F.col(f"{a}.name"), F.col(f"{b}.name"))
    scores = []
    for part in PARTS:
        x, y = F.col(f"{a}.{part}"), F.col(f"{b}.{part}")
        scores.append(F.when((x != "") & (y != ""), fuzz_score(x, y)))
    good = reduce(lambda p, q: p & q, [F.coalesce(s >= THRESHOLD, F.lit(True)) for s in scores], name >= THRESHOLD)
    return good, _confidence(name, scores)


def member_confidence(members: DataFrame, sigs: DataFrame) -> DataFrame:
    """Members with their confidence: the score against the entity's first listing where the two match."""
    as_struct = sigs.select("sid", F.struct("name", *PARTS).alias("sig"))
    roots = members.where(F.col("id") == F.col("entity_id")).select("entity_id", F.col("platform").alias("root_platform"), F.col("sid").alias("root_sid"))
    pairs = members.select("entity_id", "sid").distinct()
    root_sigs = roots.join(as_struct.select(F.col("sid").alias("root_sid"), F.col("sig").alias("root")), "root_sid")
    scored = pairs.join(as_struct, "sid").join(root_sigs.select("entity_id", "root"), "entity_id")
    good, confidence = _agreement("sig", "root")
    scored = scored.select("entity_id", "sid", good.alias("agrees"), confidence.alias("score"))
    direct = F.col("agrees") & (F.col("platform") != F.col("root_platform"))
    return (
        members.join(scored, ["entity_id", "sid"])
        .join(roots, "entity_id")
        .select(
            "entity_id", "id", "platform",
            F.when(direct, F.col("score")).otherwise(1.0).alias("confidence"),
            F.when(direct, "field_fuzzy").otherwise("cluster_member").alias("match_method"),
        )
    )


def canonical_members(members: DataFrame, pm: DataFrame) -> DataFrame:
    """One row per entity: name, address and point of its first listing, and whether it is on the own platform."""
    flags = members.groupBy("entity_id").agg(F.bool_or(F.col("platform") == OWN_PLATFORM).alias("is_on_our_platform"))
    first = pm.select(
        F.col("id").alias("entity_id"), F.col("name").alias("canonical_name"), F.col("address").alias("canonical_addr"),
        geo_point(F.col("lat"), F.col("lng")).alias("canonical_geom"),
    )
    return flags.join(first, "entity_id").select(
        F.col("entity_id").alias("id"), "canonical_name", "canonical_addr", "canonical_geom", "is_on_our_platform"
    )


def resolve_entities(pm: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merchants, merchant_matches) over all listings that have a name."""
    rows = merchants_scan(pm)
    members, sigs = cluster_listings(rows)
    matches = member_confidence(members, sigs).select(
        F.col("id").alias("platform_merchant_id"), F.col("entity_id").alias("merchant_id"), "confidence", "match_method"
    )
    return canonical_members(members, rows), matches


def resolve_entities_market(
    pm: DataFrame, market: str, merchants: DataFrame | None = None, matches: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The same for one market, fixed confidence, after the market's old result is taken out."""
    rows = merchants_scan(pm, market)
    members, _ = cluster_listings(rows)
    fresh_merchants = canonical_members(members, rows)
    fresh = members.select(
        F.col("id").alias("platform_merchant_id"), F.col("entity_id").alias("merchant_id"),
        F.lit(0.9).alias("confidence"), F.lit("local_batch").alias("match_method"),
    )
    if merchants is not None and matches is not None:
        old_merchants, old_matches = reset_resolution(pm, merchants, matches, market)
        fresh_merchants = old_merchants.unionByName(fresh_merchants, allowMissingColumns=True)
        fresh = old_matches.unionByName(fresh, allowMissingColumns=True)
    return fresh_merchants, fresh


def confidence_to_target(pm: DataFrame, target_id: int) -> DataFrame:
    """All rows with their similarity to one row: itself 1, its own platform 0."""
    cleaned = pm.withColumns(
        {"s_name": extract_restaurant_name(F.col("name")), "s_address": extract_address_fields(F.col("address"))}
    ).withColumn("sig", F.struct(F.col("s_name").alias("name"), *[F.col(f"s_address.{p}").alias(p) for p in PARTS]))
    target = match_fields(pm.where(F.col("id") == target_id)).limit(1)
    root = target.select(F.col("platform").alias("root_platform"), F.struct("name", *PARTS).alias("root"))
    _, score = _agreement("sig", "root")
    scored = F.when(F.col("id") == target_id, 1.0).when(F.col("platform") == F.col("root_platform"), 0.0).otherwise(score)
    return cleaned.crossJoin(F.broadcast(root)).select(*pm.columns, scored.alias("confidence"))


def rank_by_confidence(scored: DataFrame, n: int = 10) -> DataFrame:
    return scored.orderBy(F.desc("confidence"), "id").limit(n)


def pair_similarity(pm: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id_a, id_b, similarity) for given pairs, whether or not they would match."""
    as_struct = F.struct("name", *PARTS)
    fields = match_fields(pm)
    a = fields.select(F.col("id").alias("id_a"), as_struct.alias("a"))
    b = fields.select(F.col("id").alias("id_b"), as_struct.alias("b"))
    _, score = _agreement("a", "b")
    return pairs.join(a, "id_a").join(b, "id_b").select("id_a", "id_b", score.alias("similarity"))


def resolution_stats(pm: DataFrame) -> DataFrame:
    """Rows per platform, matching pairs, matched listings and entity clusters."""
    rows = merchants_scan(pm)
    fields = cut_lineage(_resolvable(rows))
    sigs = cut_lineage(signatures(fields))
    sides = matching_sides(sigs)
    members = members_of(fields, sigs, sides)
    figure = lambda name, value: F.struct(F.lit(name).alias("figure"), value.cast("bigint").alias("value"))
    per_platform = rows.groupBy("platform").agg(F.count("*").alias("n")).select(F.concat(F.lit("rows "), "platform").alias("figure"), F.col("n").alias("value"))
    clusters = members.agg(F.count("*").alias("n"), F.count_distinct("entity_id").alias("c")).select(
        F.inline(F.array(figure("matched listings", F.col("n")), figure("entity clusters", F.col("c"))))
    )
    pairs = _listing_pairs(fields, sigs, sides).select(F.lit("match pairs").alias("figure"), F.col("pairs").alias("value"))
    return per_platform.unionByName(clusters).unionByName(pairs)
