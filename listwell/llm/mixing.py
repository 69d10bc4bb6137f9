"""Mixing sources to target weights, in columns only.

The words of each source are packed, document after document, into blocks of a fixed length.
The mix is a row of slots, a block each, divided into output shards. Every shard draws how
many of its slots each source gets: the whole part of its share, and the slots left over by
a multinomial draw on the fractional parts. The slots of a source are numbered through all
shards; slot k takes block pi_e(k mod n), where e = k div n is the pass over the source's n
blocks and pi_e a pseudorandom permutation of its own (swap-or-not), so that blocks are
found by an equality join on their number. All draws are hashes: reruns agree.

Slots and blocks are made of a few rows each, so that Spark takes them for few: what is joined by
block or by document is told to meet by key, and neither side goes through the driver.

Offsets within a source are prefix sums over three levels of small groups, so that a source
with a third of all rows is never one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listwell.llm.common import let, staged, words

BLOCK_WORDS = 64
SHARD_SLOTS = 1 << 18
MOST_PASSES = 3
GROUP = 256
ROUNDS = 20


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size): the number of words, 0 for a null or blank text."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("bigint").alias("size"))


def targets(sized: DataFrame, most: int = MOST_PASSES) -> DataFrame:
    """(source, docs, source_size, target): one row per source, in words.

    Sources in order of code points, null last, weigh 1, 2, 3, 1, 2, 3, ... and share all
    words; a source gets at most ``most`` times its own, and the others share the rest by
    weight. The windows are over sources, of which there is one row each.
    """
    each = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = each.withColumn("w", (F.row_number().over(order) - 1) % 3 + 1).withColumn("top", most * F.col("source_size"))
    by_need = Window.orderBy(F.col("top") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        weighed.withColumn("rest", F.sum("source_size").over(everything) - F.coalesce(F.sum("top").over(before), F.lit(0)))
        .withColumn("weights", F.sum("w").over(by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("rank", F.row_number().over(by_need))
        .withColumn("open", F.col("rest") * F.col("w") <= F.col("top") * F.col("weights"))
        .withColumn("first", F.min(F.when(F.col("open"), F.col("rank"))).over(everything))
        .withColumn("rest_at", F.max(F.when(F.col("rank") == F.col("first"), F.col("rest"))).over(everything))
        .withColumn("weights_at", F.max(F.when(F.col("rank") == F.col("first"), F.col("weights"))).over(everything))
    )
    shared = F.col("rest_at").cast("double") * F.col("w") / F.col("weights_at")
    target = F.when(F.col("rank") < F.col("first"), F.col("top").cast("double")).otherwise(F.coalesce(shared, F.lit(0.0)))
    return level.select("source", "docs", "source_size", target.alias("target"))


def _uniform(*cols) -> Column:
    """A number in [0, 1) that depends on the arguments alone."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def _permuted(i: Column, n: Column, *key) -> Column:
    """Swap-or-not shuffle (Hoang, Morris and Rogaway, 2012): a permutation of 0 .. n - 1."""

    def swap(x, r):
        other = F.pmod(F.pmod(F.xxhash64(F.lit("k"), r, *key), n) - x, n)
        return F.when(F.pmod(F.xxhash64(F.lit("b"), r, F.greatest(x, other), *key), F.lit(2)) == 0, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), i.cast("bigint"), swap)


def placed(sized: DataFrame, of_source: DataFrame) -> DataFrame:
    """(doc_id, source, size, at): the place of each document's first word within its source.

    Documents are dealt by a hash of their id into groups of about GROUP, groups into groups
    of as many groups; each level adds up on its own.
    """
    s = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    counts = of_source.select(s.alias("s"), "docs")
    dealt = sized.withColumn("s", s).join(counts, "s").withColumn(
        "g", F.pmod(F.xxhash64("doc_id", "size", F.lit("deal")), F.ceil(F.col("docs") / GROUP))
    ).drop("docs").withColumn("h", F.floor(F.col("g") / GROUP)).repartition("s", "g")  # else a source stays where the counts met it
    before = lambda *part: Window.partitionBy(*part)
    up = (Window.unboundedPreceding, -1)
    so_far = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(*up)), F.lit(0))
    groups = dealt.groupBy("s", "h", "g").agg(F.sum("size").alias("size"))
    uppers = groups.groupBy("s", "h").agg(F.sum("size").alias("size")).select(
        "s", "h", so_far(before("s").orderBy("h")).alias("at_h")
    )
    lower = groups.select("s", "h", "g", so_far(before("s", "h").orderBy("g")).alias("at_g"))
    base = lower.join(uppers, ["s", "h"]).select("s", "g", (F.col("at_h") + F.col("at_g")).alias("base"))
    inside = dealt.withColumn("off", so_far(before("s", "g").orderBy("doc_id", "size")))
    return inside.join(base, ["s", "g"]).select("doc_id", "source", "s", "size", (F.col("base") + F.col("off")).alias("at"))


def slots(of_source: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, most: int = MOST_PASSES, seed: int = 7) -> DataFrame:
    """(shard, s, pass, block): every slot of the mix with the block that fills it.

    A source at its ceiling has ``most`` passes at most; the few slots that a draw gives it
    beyond them stay empty.
    """
    s = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    everything = Window.partitionBy()
    plan = (
        of_source.where("source_size > 0").select(s.alias("s"), F.ceil(F.col("source_size") / block_words).alias("n"), "source_size", "target")
        .withColumn("want", F.col("target") * F.col("n") / F.col("source_size"))
        .withColumn("all", F.round(F.sum("want").over(everything)).cast("bigint"))
        .withColumn("p", F.col("want") / F.sum("want").over(everything))
    )
    shards = plan.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.greatest(F.col("all") - 1, F.lit(0)) / shard_slots)))).withColumn(
        "m", F.least(F.lit(shard_slots), F.col("all") - F.col("shard") * shard_slots)
    )
    of_shard = Window.partitionBy("shard")
    split = (
        shards.withColumn("whole", F.floor(F.col("m") * F.col("p"))).withColumn("part", F.col("m") * F.col("p") - F.col("whole"))
        .withColumn("hi", F.sum("part").over(of_shard.orderBy("s")))
        .withColumn("parts", F.sum("part").over(of_shard)).withColumn("draws", F.col("m") - F.sum("whole").over(of_shard))
        .withColumn("lo", (F.col("hi") - F.col("part")) / F.col("parts")).withColumn("hi", F.col("hi") / F.col("parts"))
        .withColumn("last", F.row_number().over(of_shard.orderBy(F.desc("s"))) == 1)
    )
    drawn = F.when(F.col("draws") > 0, F.size(F.filter(
        F.sequence(F.lit(1).cast("bigint"), F.greatest(F.col("draws"), F.lit(1))),
        lambda d: (_uniform(F.lit(seed), F.col("shard"), d) >= F.col("lo")) & ((_uniform(F.lit(seed), F.col("shard"), d) < F.col("hi")) | F.col("last")),
    ))).otherwise(0)
    counted = split.withColumn("count", F.col("whole") + drawn)
    start = F.coalesce(F.sum("count").over(Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = counted.withColumn("start", start).where("count > 0").select("shard", "s", "n", "start", "count", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("count") - 1) / 4096))).alias("run"))
    return (
        runs.repartition(int(of_source.sparkSession.conf.get("spark.sql.shuffle.partitions")), "s", "shard", "run")
        .select("shard", "s", "n", F.explode(F.sequence(F.col("start") + F.col("run") * 4096, F.col("start") + F.least(F.col("count"), (F.col("run") + 1) * 4096) - 1)).alias("k"))
        .withColumn("pass", F.floor(F.col("k") / F.col("n"))).where(F.col("pass") < most)
        .select("shard", "s", "pass", _permuted(F.pmod("k", "n"), F.col("n"), F.lit(seed), F.col("s"), F.col("pass")).alias("block"))
    )


def blocks(at: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(s, block, doc_id, size, first, n): the words of each document that lie in each block; first counts from 0."""
    b = F.col("block")
    start = F.greatest(F.col("at"), b * block_words)
    return (
        at.where("size > 0")
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / block_words), F.floor((F.col("at") + F.col("size") - 1) / block_words))))
        .select("s", "block", "doc_id", "size", (start - F.col("at")).alias("first"), (F.least(F.col("at") + F.col("size"), (b + 1) * block_words) - start).alias("n"))
    )


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, size, source, source_size, target, taken), one row per document.

    ``taken`` counts the words that the mix takes from the document, repeats included; it is
    at most three times ``size``. Null texts have size 0 and are never taken; a null source
    is a source, the last. Rows that share id, source and size lie next to each other and
    are told apart by their place. Other columns are left out.
    """
    sized = staged(sizes(docs, doc_id, text, source))
    of_source = targets(sized)
    at = placed(sized, of_source)
    times = slots(of_source, block_words).groupBy("s", "block").agg(F.count("*").alias("times"))
    pieces = blocks(at.withColumn("doc_id", F.struct("doc_id", "at")), block_words)
    taken = pieces.join(times.hint("merge"), ["s", "block"]).groupBy("s", F.col("doc_id.doc_id").alias("doc_id"), F.col("doc_id.at").alias("at")).agg(
        F.sum(F.col("n") * F.col("times")).alias("taken")
    )
    mine = at.alias("x").join(
        taken.alias("y").hint("merge"),
        (F.col("x.s") == F.col("y.s")) & F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")) & (F.col("x.at") == F.col("y.at")) & (F.col("x.size") > 0),
        "left",
    ).select("x.doc_id", "x.source", "x.size", "x.s", F.coalesce("y.taken", F.lit(0)).alias("taken"))
    s = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    return mine.join(of_source.select(s.alias("s"), "source_size", "target"), "s").select("doc_id", "size", "source", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents: a row for each document and pass that takes some of its words.

    The text has the words taken in that pass, in order; where the pass takes all of them it
    is the document's own text. Columns and their order stay, ``n_chars`` follows the text.
    Rows equal in id, source and text are mixed as rows of their own and take their other
    columns from one of them.
    """
    kind = dict(docs.dtypes).get("n_chars")
    keyed = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("k_id"), F.xxhash64("text").alias("k_hash"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")).alias("k_s"), F.col("source").alias("k_source"), F.size(words(F.col("text"))).cast("bigint").alias("k_size"),
    )
    sized = staged(keyed.select(F.struct("k_id", "k_hash").alias("doc_id"), F.col("k_source").alias("source"), F.col("k_size").alias("size")))
    of_source = targets(sized)
    pieces = blocks(placed(sized, of_source).withColumn("doc_id", F.struct("doc_id", "at")), block_words)
    picked = pieces.join(slots(of_source, block_words).select("s", "block", "pass").hint("merge"), ["s", "block"]).groupBy("s", "doc_id", "pass").agg(
        F.array_sort(F.collect_list(F.struct("first", "n"))).alias("parts"), F.sum("n").alias("taken")
    ).select(F.col("s").alias("p_s"), F.col("doc_id.doc_id.k_id").alias("p_id"), F.col("doc_id.doc_id.k_hash").alias("p_hash"), "parts", "taken")
    own = keyed.where("k_size > 0").select("_row", "k_id", "k_hash", "k_s", "k_size").dropDuplicates(["k_id", "k_hash", "k_s"])
    chosen = picked.join(own.hint("merge"), F.col("k_id").eqNullSafe(F.col("p_id")) & (F.col("k_hash") == F.col("p_hash")) & (F.col("k_s") == F.col("p_s")))
    text = F.col("_row")["text"]
    some = let(words(text), lambda w: F.array_join(F.flatten(F.transform("parts", lambda p: F.slice(w, (p["first"] + 1).cast("int"), p["n"].cast("int")))), " "))
    out = chosen.select("_row", F.when(F.col("taken") == F.col("k_size"), text).otherwise(some).alias("k_text"))
    own_columns = {"text": F.col("k_text")} | ({"n_chars": F.length("k_text").cast(kind)} if kind else {})
    return out.select(*[own_columns.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
