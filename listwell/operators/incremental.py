"""Entity resolution that goes on from an earlier run: new listings are matched, old ids stay.

A run leaves a :class:`Resolution`: the cleaned listings, their signatures, the entities, and an
index of fuzzy keys with the frequencies it was made with. A later batch brings new or changed
listings. Only signatures that are new, that a second platform has joined, or whose entity lost a
listing take part as the left side of the matching; they look up the index, within the markets and
under the addresses they have. What matches is tied to the old entities by edges between
entities, not listings, and components are found among those alone.

Which id survives: an entity that holds old ones keeps the least id of theirs; an id belongs to
where the listing it was named after is now. An entity without an old id is named after its least listing.
Entities, as sets of listings, are those of a run over everything.
"""

from __future__ import annotations

from dataclasses import dataclass, fields as fields_of

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwell.operators import match as mt
from listwell.operators.components import connected_components
from listwell.operators.fuzzy import key_frequencies, similar_to_new, text_keys
from listwell.plans.quality import market_mode
from listwell.session import cut_lineage, spread

SIG, PARTS, KEYS = list(mt.SIGNATURE), mt.PARTS, list(mt.KEYS)


@dataclass
class Resolution:
    """What a run leaves behind; every part is a table."""

    listings: DataFrame  # id, platform, given_market, market, name, street_number, street_name, city
    signatures: DataFrame  # sid, market, name, street_number, street_name, city, side
    members: DataFrame  # entity_id, id, platform, sid
    frequencies: DataFrame  # kind, key, texts
    keys: DataFrame  # value, span, key, left, right

    def save(self, path: str) -> None:
        for f in fields_of(self):
            getattr(self, f.name).write.mode("overwrite").parquet(f"{path}/{f.name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Resolution:
        return cls(**{f.name: spark.read.parquet(f"{path}/{f.name}") for f in fields_of(cls)})


def _cleaned(rows: DataFrame) -> DataFrame:
    cleaned = mt.match_fields(spread(rows.dropDuplicates(["id"]), "id"))
    return cleaned.select("id", "platform", F.col("market").alias("given_market"), "name", *PARTS)


def _usual_market(cleaned: DataFrame) -> str:
    return market_mode(cleaned.select(F.col("given_market").alias("market"))).first()["market"]


def _placed(cleaned: DataFrame, usual: str) -> DataFrame:
    """Listings with their market; those that give none get the usual one."""
    return cleaned.withColumn("market", F.coalesce("given_market", F.lit(usual))).select("id", "platform", "given_market", *SIG)


def _texts(signatures: DataFrame) -> DataFrame:
    values = F.explode(F.array("name", *PARTS)).alias("value")
    return signatures.select(values).where("value <> ''").distinct()


def _resolved(placed: DataFrame) -> DataFrame:
    """Members of a run over everything."""
    mixed = cut_lineage(mt.in_mixed_markets(placed.drop("given_market")))
    sigs = cut_lineage(mt.signatures(mixed))
    return mt.members_of(mixed, sigs, mt.matching_sides(sigs))


def first_resolution(pm: DataFrame) -> Resolution:
    """A run over everything, with what the next one goes on from. Listings without a name are left out."""
    cleaned = _cleaned(mt.merchants_scan(pm))
    placed = cut_lineage(_placed(cleaned, _usual_market(cleaned)))
    sigs = cut_lineage(mt.signatures(placed))
    frequencies = cut_lineage(key_frequencies(_texts(sigs)))
    keys = cut_lineage(text_keys(_texts(sigs), frequencies))
    return Resolution(placed, sigs, _resolved(placed), frequencies, keys)


def _equal(a: str, b: str, columns: list[str]):
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return cond


def _sides_of_new(new: DataFrame, known: DataFrame, keys: DataFrame) -> mt.Sides:
    """As ``matching_sides``, with new signatures on the left and all of their markets on the right."""
    first = ["street_number", "city"]

    def values(sigs: DataFrame) -> DataFrame:
        each = F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).alias("value")) for p in first])
        return sigs.select("market", F.inline(each)).where("value <> ''").distinct()

    def under(rows: DataFrame, column: str, on: list[str]) -> DataFrame:
        return rows.select("market", *on, F.col(column).alias("value")).where("value <> ''").distinct()

    near = similar_to_new(values(new), values(known), keys, ["market", "part"], ["market", "part"])
    short = cut_lineage(mt.partners(new, tuple(first), near))
    number = ("street_number",)
    by_number = [mt.KEY_OF["street_number"]]
    streets = similar_to_new(
        under(mt.partner_keys(new, short, number), "street_name", by_number), under(mt.own_keys(known, number), "street_name", by_number),
        keys, ["market", *by_number], ["market"],
    ).withColumn("part", F.lit("street_name"))
    partners = cut_lineage(short.unionByName(mt.partners(new, ("street_name",), streets)))
    left = mt.partner_keys(new, partners, PARTS).select("sid", "side", "market", "name", *KEYS, *[f"{k}_score" for k in KEYS])
    right = mt.own_keys(known, PARTS).select("sid", "side", "market", "name", *KEYS)
    left = cut_lineage(left.join(right.select("market", *KEYS).distinct(), ["market", *KEYS], "left_semi"))
    right = cut_lineage(right.join(left.select("market", *KEYS).distinct(), ["market", *KEYS], "left_semi"))
    near = similar_to_new(under(left, "name", KEYS), under(right, "name", KEYS), keys, ["market", *KEYS], ["market"])
    pair = lambda a, b: F.struct(F.col(a).alias("name"), F.col(b).alias("other"), F.col("score").alias("name_score"))
    both = near.select("market", F.inline(F.array(pair("value_a", "value_b"), pair("value_b", "value_a"))))
    same = new.select("market", "name").distinct().select("market", "name", F.col("name").alias("other"), F.lit(100.0).alias("name_score"))
    names = cut_lineage(both.unionByName(same))
    return left.join(names, ["market", "name"]), right.withColumnRenamed("name", "other")


def keep_ids(members: DataFrame, old: DataFrame) -> DataFrame:
    """Members of a run over everything, under the ids of an earlier run wherever those are still there."""
    held = members.join(old.select("entity_id").distinct().select(F.col("entity_id").alias("id")), "id")
    kept = held.groupBy("entity_id").agg(F.min("id").alias("kept"))
    return members.join(kept, "entity_id", "left").select(F.coalesce("kept", "entity_id").alias("entity_id"), "id", "platform", "sid")


def resolve_delta(state: Resolution, batch: DataFrame) -> Resolution:
    """The state after new and changed listings.

    ``batch`` holds whole rows; of rows with one id any one counts. A row that says what is known already
    changes nothing, and an empty batch gives the state as it is. Listings are never taken away. If the most usual market,
    which listings without one get, turns out to be another, everything is matched anew and ids are kept.
    """
    rows = cut_lineage(_cleaned(mt.merchants_scan(batch)))
    own = ["id", "platform", "given_market", "name", *PARTS]
    fresh = cut_lineage(rows.alias("n").join(state.listings.select(*own).alias("o"), _equal("n", "o", own), "left_anti"))
    kept = state.listings.join(fresh.select("id"), "id", "left_anti")
    usual = _usual_market(kept.select("given_market").unionByName(fresh.select("given_market")))
    before = _usual_market(state.listings)
    arrived = _placed(fresh, usual)
    if usual != before:
        listings = cut_lineage(_placed(kept.drop("market"), usual).unionByName(arrived))
        sigs = cut_lineage(mt.signatures(listings))
        keys = cut_lineage(state.keys.unionByName(_new_keys(state, sigs)))
        return Resolution(listings, sigs, keep_ids(_resolved(listings), state.members), state.frequencies, keys)
    listings = cut_lineage(kept.unionByName(arrived))
    left = state.listings.join(fresh.select("id"), "id", "left_semi")

    # Signatures that listings came to or left are made anew, the others stay.
    touched = cut_lineage(arrived.select(*SIG).union(left.select(*SIG)).distinct())
    made = mt.signatures(listings.join(touched, SIG, "left_semi"))
    sigs = cut_lineage(state.signatures.join(touched, SIG, "left_anti").unionByName(made.select(*state.signatures.columns)))

    # Entities that lost a listing are taken apart.
    broken = cut_lineage(state.members.join(left.select("id"), "id", "left_semi").select("entity_id").distinct())
    named = state.members.select("sid", "entity_id").distinct().join(state.signatures.select("sid", *SIG), "sid").drop("sid")
    loose = named.join(broken, "entity_id", "left_semi").select(*SIG)
    labels = named.join(broken, "entity_id", "left_anti")
    known = sigs.join(state.signatures.select(*SIG, "side"), [*SIG, "side"], "left_semi").join(loose, SIG, "left_anti")
    new = cut_lineage(sigs.join(known.select("sid"), "sid", "left_anti"))
    near = sigs.join(new.select("market").distinct(), "market", "left_semi")
    keys = cut_lineage(state.keys.unionByName(_new_keys(state, new)))
    edges = cut_lineage(mt.key_edges(_sides_of_new(new, near, keys)))

    # Components of entities and of signatures that are in none.
    node = cut_lineage(sigs.join(labels, SIG, "left").select("sid", *SIG, F.col("entity_id").alias("label"), F.coalesce("entity_id", "sid").alias("node")))
    at = lambda end: node.select(F.col("sid").alias(end), F.col("node").alias(f"{end}_node"))
    tied = edges.join(at("src"), "src").join(at("dst"), "dst").select("src_node", "dst_node").distinct()
    found = cut_lineage(connected_components(tied, "src_node", "dst_node"))
    roots = listings.join(broken, F.col("id") == F.col("entity_id"), "left_semi").select("id", *SIG)
    claims = labels.select(F.col("entity_id").alias("node"), F.col("entity_id").alias("claim")).distinct().unionByName(
        roots.join(node, SIG).select("node", F.col("id").alias("claim"))
    )
    kept_ids = found.join(claims, F.col("member_id") == F.col("node")).groupBy(F.col("entity_id").alias("least")).agg(F.min("claim").alias("claim"))
    final = found.join(kept_ids, F.col("entity_id") == F.col("least"), "left").select(F.col("member_id").alias("node"), F.coalesce("claim", "entity_id").alias("final"))
    final = cut_lineage(final)

    # Members of what changed are written anew, the others go on under their entity's name.
    renamed = node.join(final, "node", "left").select("sid", *SIG, "label", F.coalesce("final", "label").alias("entity_id")).where("entity_id IS NOT NULL")
    redo = renamed.join(touched, SIG, "left_semi").unionByName(renamed.join(touched, SIG, "left_anti").where("label IS NULL")).drop("label")
    redone = listings.join(redo, SIG).select("entity_id", "id", "platform", "sid")
    going = state.members.join(broken, "entity_id", "left_anti").join(redone.select("id"), "id", "left_anti").join(fresh.select("id"), "id", "left_anti")
    going = going.join(final, F.col("entity_id") == F.col("node"), "left").select(F.coalesce("final", "entity_id").alias("entity_id"), "id", "platform", "sid")
    return Resolution(listings, sigs, cut_lineage(going.unionByName(redone)), state.frequencies, keys)


def _new_keys(state: Resolution, sigs: DataFrame) -> DataFrame:
    """Keys of texts that the index has not met, under its own frequencies."""
    unmet = _texts(sigs).join(state.keys.select("value").distinct(), "value", "left_anti")
    return text_keys(unmet, state.frequencies)
