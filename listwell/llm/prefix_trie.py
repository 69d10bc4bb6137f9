"""Prefix trie of conversations by fixed-length block hashing.

A conversation is cut into blocks of BLOCK turns, and each block has one digest. The digest
of all blocks before a block names a node of the trie at a block boundary, so that
grouping by (node, block digest) finds which conversations go on alike for a whole block,
without looking at single turns. Only under a node whose members go on with different
blocks are turns looked at: there the distinct blocks, with their numbers of members,
are split into turns and grouped by the digest of each shorter prefix. A block that has
no sibling gives its nodes as they are.

Figures of subtrees need no walk through the levels. A conversation passes through all nodes
above its end, so anything summed over a subtree is a sum over its members once each node is
credited to one of them: the smallest.

* Leaves: credited to the smallest member, summed over members.
* Tokens of a subtree's distinct nodes: conversation c is the smallest member of a run of
  nodes that ends at its end, and is credited with their sizes. All such credits of the members
  of node v lie below v, but those of v's own smallest member, of which the nodes from v on count.
* Tokens of all members from v on: their whole sizes less what lies before v, which is equal for all.

Prefix digests over many blocks are made in strips of FAN blocks. Strips have digests of
their own, whose prefixes are made in the same way, so a conversation of any length
takes bounded rows. All sums start before the shuffle, so a third of all conversations may be alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwell.llm.common import numbered, staged

BLOCK, FAN = 8, 64
ROOT = ""
SUMS = ("n_convs", "total", "own", "leaves")


def digest(*parts: Column) -> Column:
    """128 bits of SHA-256 of the parts together, in hexadecimal."""
    return F.substring(F.sha2(F.concat(*parts), 256), 1, 32)


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, size) of each turn; pos counts from 1.

    Turns go by ``turn`` with null first, equal ones by role and then by text; null roles and
    texts count as empty. Rows without a conv_id belong to no conversation. Positions come from
    ranks over ranges of all turns, so a conversation may hold any share of them. Texts
    are shuffled once; from there on a turn is its digest and its number of code points.
    """
    said = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", said("role"), said("text"))
    # Equal rows are told apart by their place in the input, so that they need not share a partition.
    rows = rows.withColumn("same", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "text", "same"]
    ranked = numbered(
        rows, order, keep=["conv_id", digest(F.length("role").cast("string"), F.lit(":"), "role", "text").alias("digest"), F.length("text").alias("size")]
    )
    first = ranked.groupBy("conv_id").agg(F.min("number").alias("first"))
    return ranked.join(first, "conv_id").select("conv_id", (F.col("number") - F.col("first") + 1).alias("pos"), "digest", "size")


def rebuilt(turns: DataFrame, ids: DataFrame, base: Column, most: Column, longest: int) -> DataFrame:
    """Turns of conversations that begin as another one does.

    ``base`` and ``most`` are columns of ``ids`` (conv_id): the conversation to begin as, and how many
    turns, ``longest`` at most, to take from it (all where it has fewer, none where it is absent); as
    many of the conversation's own turns are left out.
    """
    heads = turns.where(F.col("pos") <= longest).join(ids.select(base.alias("conv_id")).distinct(), "conv_id", "left_semi")
    heads = heads.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "size"))).alias("head"))
    plan = (
        ids.select("conv_id", base.alias("base"), most.alias("most"))
        .join(heads.withColumnRenamed("conv_id", "base"), "base", "left")
        .select("conv_id", "most", F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,digest:string,size:int>>")), F.lit(1), F.col("most")).alias("head"))
    )
    moved = turns.join(plan.select("conv_id", "most", F.size("head").alias("taken")), "conv_id").where("pos > most")
    own = moved.select("conv_id", (F.col("pos") - F.col("most") + F.col("taken")).alias("pos"), "digest", "size")
    return own.unionByName(plan.select("conv_id", F.inline("head")))


def _strips(items: DataFrame, span: int) -> DataFrame:
    """(conv_id, strip, items): up to ``span`` items (pos, digest, size) each, in order; pos counts from 1."""
    strip = F.expr(f"(pos - 1) div {span}").alias("strip")
    return items.groupBy("conv_id", strip).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "size"))).alias("items"))


def _with_starts(strips: DataFrame) -> DataFrame:
    """Adds ``start``, ``start_size`` (digest and size of all before the strip) and ``goal`` (digest up to its end, if full)."""
    if strips.agg(F.max("strip")).first()[0] in (0, None):
        return strips.select("*", F.lit(ROOT).alias("start"), F.lit(0).cast("bigint").alias("start_size"), F.lit(None).cast("string").alias("goal"))
    size = F.aggregate("items", F.lit(0).cast("bigint"), lambda s, t: s + t["size"])
    own = digest(F.array_join(F.transform("items", lambda t: t["digest"]), ""))
    above = _strips(strips.select("conv_id", (F.col("strip") + 1).alias("pos"), own.alias("digest"), size.alias("size")), FAN)
    one = _unrolled(_with_starts(above), FAN, 1).select("conv_id", (F.col("item_no") - 1).alias("strip"), F.col("before").alias("start"), F.col("after").alias("goal"), F.col("before_size").alias("start_size"))
    return strips.join(one, ["conv_id", "strip"])


def _unrolled(strips: DataFrame, span: int, block: int) -> DataFrame:
    """One row per block of ``block`` items of each strip.

    ``before`` and ``after`` are digests of all that lies before the block and of that with the block,
    ``before_size`` the size before it; ``after`` names a boundary only for a full block.
    """
    blocks = F.expr(f"transform(sequence(0, (size(items) - 1) div {block}), i -> slice(items, i * {block} + 1, {block}))")
    own = F.transform("blocks", lambda b: F.struct(
        digest(F.array_join(F.transform(b, lambda t: t["digest"]), "")).alias("digest"),
        F.aggregate(b, F.lit(0).cast("bigint"), lambda s, t: s + t["size"]).alias("size"),
    ))
    joined = lambda n: F.array_join(F.transform(F.slice("own", F.lit(1), n), lambda o: o["digest"]), "")
    upto = lambda n: F.when(n == 0, F.col("start")).otherwise(digest(F.col("start"), joined(n)))
    per_strip = span // block
    rows = F.transform("blocks", lambda b, i: F.struct(
        (F.col("strip") * per_strip + i + 1).alias("item_no"), upto(i).alias("before"),
        F.when((i == per_strip - 1) & F.col("goal").isNotNull(), F.col("goal")).otherwise(upto(i + 1)).alias("after"),
        (F.col("start_size") + F.aggregate(F.slice("own", F.lit(1), i), F.lit(0).cast("bigint"), lambda s, o: s + o["size"])).alias("before_size"),
        F.get("own", i)["digest"].alias("block"), b.alias("turns"),
    ))
    return strips.withColumn("blocks", blocks).withColumn("own", own).select("conv_id", F.inline(rows))


def _blocks(turns: DataFrame) -> DataFrame:
    """One row per conversation and block, staged: where it begins, its digest, its turns."""
    span = BLOCK * FAN
    rows = _unrolled(_with_starts(staged(_strips(turns, span))), span, BLOCK)
    turns_of = lambda field: F.transform("turns", lambda t: t[field])
    depth = ((F.col("item_no") - 1) * BLOCK).alias("depth")
    return staged(rows.select("conv_id", depth, "before", "after", "before_size", "block", turns_of("digest").alias("digests"), turns_of("size").alias("sizes")))


def _below(turn: Column) -> Column:
    """Digest that names the node after ``turn`` + 1 turns of a block."""
    inside = digest(F.col("before"), F.lit("/"), F.array_join(F.slice("digests", F.lit(1), turn + 1), ""))
    return F.when(turn + 1 == BLOCK, F.col("after")).otherwise(inside)


def _nodes(blocks: DataFrame, sums: list[str]) -> DataFrame:
    """Nodes below the root: id, parent, depth, size of the last text, size before it, ``low`` (least member), the sums."""
    same = ["before", "block", "after", "depth", "before_size", "digests", "sizes"]
    added = [F.sum(c).alias(c) for c in sums]
    kinds = blocks.groupBy(*same).agg(F.min("conv_id").alias("low"), *added)
    sole = kinds.groupBy("before").agg(F.min("block").alias("block"), F.max("block").alias("last")).where("block = last")
    kinds = kinds.join(sole.select("before", "block", F.lit(True).alias("alone")), ["before", "block"], "left")
    # Sizes are those of the turn itself and of all before it.
    turn = F.posexplode(F.col("sizes")).alias("at", "size")
    rows = kinds.select("*", turn).select(
        _below(F.col("at")).alias("id"), F.when(F.col("at") == 0, F.col("before")).otherwise(_below(F.col("at") - 1)).alias("parent"),
        (F.col("depth") + F.col("at") + 1).alias("depth"), F.col("size").cast("bigint").alias("size"),
        (F.col("before_size") + F.aggregate(F.slice("sizes", F.lit(1), F.col("at")), F.lit(0).cast("bigint"), lambda s, x: s + x)).alias("before_size"),
        "low", *sums, F.coalesce("alone", F.lit(False)).alias("alone"),
    )
    plain = rows.where("alone").drop("alone")
    refined = rows.where("NOT alone").groupBy("id", "parent", "depth", "size", "before_size").agg(F.min("low").alias("low"), *added)
    return plain.unionByName(refined.select(*plain.columns))


def prefix_trie(turns: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the trie of conversations.

    ``turns`` holds (conv_id, pos, digest, size), pos from 1 without gaps; ``ids`` every conv_id once, also
    those without turns, which end at the root. Nodes: id, conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens. Ends: (conv_id, id) of the node each conversation ends at.
    No conversations, no nodes.
    """
    blocks = _blocks(turns)
    long = lambda value: F.lit(value).cast("bigint")
    first = staged(_nodes(blocks, []))
    children = first.groupBy("parent").agg(F.count("*").alias("n_children"))
    childless = first.join(children.select(F.col("parent").alias("id")), "id", "left_anti")
    sized = blocks.select("conv_id", F.aggregate("sizes", long(0), lambda s, x: s + x).alias("total"), long(0).alias("own"), long(0).alias("leaves"))
    figures = (
        sized.unionByName(first.select(F.col("low").alias("conv_id"), long(0).alias("total"), F.col("size").alias("own"), long(0).alias("leaves")))
        .unionByName(childless.select(F.col("low").alias("conv_id"), long(0).alias("total"), long(0).alias("own"), long(1).alias("leaves")))
        .groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in SUMS[1:]])
    )
    figures = staged(figures.withColumn("n_convs", long(1)))
    summed = _nodes(blocks.join(figures, "conv_id"), list(SUMS))
    # The smallest member counts with its nodes from this one on, others with all their own.
    least = figures.select(F.col("conv_id").alias("low"), (F.col("total") - F.col("own")).alias("low_before"))
    whole = F.col("total") - F.col("n_convs") * F.col("before_size")
    once = F.col("own") + F.col("low_before") - F.col("before_size")
    # Nodes right below the root, very many at times, look for no parent: their keys are all different.
    above = F.when(F.col("depth") == 1, F.concat(F.lit("-"), "id")).otherwise(F.col("parent"))
    below = (
        summed.join(least, "low").join(children.withColumnRenamed("parent", "id"), "id", "left").withColumn("parent", above)
        .join(first.select(F.col("id").alias("parent"), F.col("low").alias("parent_low")), "parent", "left")
    )
    everyone = ids.agg(F.min("conv_id").alias("root_conv"), F.count("*").alias("root_convs"))
    all_figures = figures.agg(*[F.sum(c).alias(c) for c in SUMS[1:]])
    top = first.where("depth = 1").agg(F.count("*").alias("n_children"))
    root = everyone.crossJoin(all_figures).crossJoin(top).where("root_convs > 0").select(
        F.lit(ROOT).alias("id"), F.col("root_conv").alias("conv_id"), long(0).alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"),
        F.col("root_convs").alias("n_convs"), "n_children", F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaves")).cast("bigint").alias("n_leaves"),
        F.coalesce(F.col("total") - F.col("own"), long(0)).alias("saved_tokens"),
    )
    nodes = below.crossJoin(F.broadcast(everyone.select("root_conv"))).select(
        "id", F.col("low").alias("conv_id"), "depth", F.when(F.col("depth") == 1, F.col("root_conv")).otherwise(F.col("parent_low")).alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", long(0)).alias("n_children"), F.col("leaves").alias("n_leaves"), (whole - once).alias("saved_tokens"),
    )
    last = blocks.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    ended = blocks.join(last, ["conv_id", "depth"]).select("conv_id", _below(F.size("sizes") - 1).alias("id"))
    empty = ids.select("conv_id").join(last, "conv_id", "left_anti").select("conv_id", F.lit(ROOT).alias("id"))
    return root.unionByName(nodes), ended.unionByName(empty)


def ids_digests(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256): SHA-256 of the conv_ids that end at a node, ascending, joined by commas.

    Ids go in stretches of 4,096 numbers, one string each. A node's strings are hashed one after
    the other as they stream in, so no task holds more than a batch of them.
    """
    import hashlib

    import pyarrow as pa

    runs = ends.groupBy("id", F.shiftright("conv_id", 12).alias("stretch")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"))

    def hashed(batches):
        node, state = None, None
        for batch in batches:
            done = []
            for name, ids in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
                if name != node:
                    if state is not None:
                        done.append((node, state.hexdigest()))
                    node, state = name, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in done], pa.string()), pa.array([b for _, b in done], pa.string())], ["id", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["id", "ends_sha256"])

    return runs.repartition("id").sortWithinPartitions("id", "stretch").select("id", "ids").mapInArrow(hashed, "id string, ends_sha256 string")
