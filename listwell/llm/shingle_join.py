"""Exact n-gram Jaccard join of whole documents, by skipping with set relations.

Equal sets are one class. The shingles of a class are put in a global order, rare ones
first, and its prefix is indexed: two sets that link share a shingle of their prefixes.
Index lists are cut into blocks by set size, of which only neighbours meet, and entries are
skipped by position: what is left of the sets from the first shared shingle on must be able
to give the similarity (index-level skipping).

A list is not compared pair by pair. In a first round each class of a block is compared with
the block's pivot, and keeps the distance to it. Distance is a metric: what is known of a
pivot's answers decides most other pairs of its block without looking at their sets
(answer-level skipping). Classes already linked through a pivot need no more comparing,
since the result is the components; and two classes whose distances to a common pivot differ
by more than the bound cannot link. Only the pairs left over are compared in a second round,
so that no link between different components is missed.

The order comes from a table of ORDER_CELLS counts, whatever the number of shingles; counts
that share a cell change the work, never the result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwell.llm.common import WordHash, mixed, pieces, staged, texts
from listwell.operators.components import connected_components

ORDER_CELLS = 1 << 20
SEGMENTS = 64
LEVELS = 8  # levels of the order for each doubling of a count
SHARD_SHINGLES = 2_000_000
SET_BYTES = 6
#: What a shard's index lists are made of.
LIST = {"token": np.uint64, "class": np.int64, "size": np.int32, "at": np.int32}


def shingles(found: list[bytes], n: int, hashes: WordHash) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; all words as one where there are fewer, none without words."""
    if not found:
        return np.zeros(0, np.uint64)
    w = hashes.of(found)
    take = min(n, len(w))
    acc = np.full(len(w) - take + 1, take, np.uint64)
    for i in range(take):
        acc = mixed(acc + w[i : len(w) - take + 1 + i])
    return np.unique(acc)


def prefix_length(size: int, least: float) -> int:
    """How many of a set's first shingles must be indexed."""
    return size - math.ceil(least * size - 1e-9) + 1


def _sets(batches, n: int):
    hashes = WordHash()
    for b in pieces(batches, "text"):
        yield b, [shingles(t.lower().split(), n, hashes) for t in texts(b, "text")]


def _print(s: np.ndarray) -> int:
    """A 64-bit fingerprint of a set."""
    x = np.array([len(s)], np.uint64) + mixed(s ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    return int(mixed(x).view(np.int64)[0])


def _packed(s: np.ndarray) -> bytes:
    """The upper SET_BYTES of each hash, distinct and in order, for comparing two sets."""
    return np.unique(s >> np.uint64(64 - 8 * SET_BYTES)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SET_BYTES].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // SET_BYTES, 8), np.uint8)
    out[:, :SET_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, SET_BYTES)
    return out.view("<u8").reshape(-1)


def _levels(parts: DataFrame) -> np.ndarray:
    """The level of each cell, about LEVELS times the logarithm of its number of shingles, from (i, part) of all tasks."""

    def summed(batches):
        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for i, part in zip(b.column("i").to_pylist(), b.column("part").to_pylist()):
                sums[i] = sums.get(i, 0) + np.frombuffer(unpack.decompress(part), "<u4").astype(np.int64)
        for i, total in sums.items():
            yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "part": [total.tobytes()]})

    levels = np.zeros((SEGMENTS, ORDER_CELLS // SEGMENTS), np.uint8)
    for row in parts.repartition(SEGMENTS, "i").mapInArrow(summed, "i int, part binary").collect():  # ORDER_CELLS numbers, whatever the input
        levels[row.i] = np.minimum(np.log2(1 + np.frombuffer(row.part, np.int64)) * LEVELS, 255).astype(np.uint8)
    return levels.reshape(-1)


def _ordered(s: np.ndarray, levels: np.ndarray) -> np.ndarray:
    return s[np.argsort(levels[(s >> np.uint64(44)).astype(np.int64)], kind="stable")]


def _bodies(needed: DataFrame, base: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """(class, set) of the classes in ``needed``, written once for all comparing."""
    speakers = classes.join(needed, "class").select(F.col("speaker").alias("s_row"), "class")

    def whole(batches):
        for b, found in _sets(batches, n):
            yield pa.RecordBatch.from_pydict({"class": b.column("class"), "set": pa.array([_packed(s) for s in found], pa.binary())})

    # joined by row, so that rows which repeat are in one place
    return staged(base.join(speakers, F.col("row") == F.col("s_row")).dropDuplicates(["row"]).select("class", "text").mapInArrow(whole, "class bigint, set binary"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()


def _compared(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """(a, b, inter, size_a, size_b) of the pairs: whole sets against each other."""
    side = lambda x: bodies.select(F.col("class").alias(x), F.col("set").alias(f"set_{x}"))

    def meet(batches):
        for b in batches:
            rows = [(x, y, len(np.intersect1d(sx, sy, assume_unique=True)), len(sx), len(sy)) for x, y, sx, sy in (
                (x, y, _unpacked(p), _unpacked(q)) for x, y, p, q in zip(*[b.column(c).to_pylist() for c in ("a", "b", "set_a", "set_b")]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)], names=["a", "b", "inter", "size_a", "size_b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(meet, "a bigint, b bigint, inter bigint, size_a bigint, size_b bigint")


def shingle_join(
    docs: DataFrame, n: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, tie, n_shingles, component_id, class_id, first), one row per row of ``docs``.

    A document's set: its distinct n-word shingles, with A-Z in lower case; all words as one
    where it has fewer than n; empty without words. Documents link if 100 * intersection >=
    percent * union; empty ones with nothing. ``component_id`` is the least doc_id that links
    reach, null only where all are null; ``class_id`` names documents with equal sets.
    ``tie`` is a hash of the text; ``first`` marks the rows with the component's least
    (doc_id, tie), null ids last, so that rows equal in id and text are first together; empty
    documents are all first. Other columns are left out. Hashes of 64 bits stand for
    shingles and sets, and their upper 48 bits for shingles when two sets are compared.
    """
    spark = docs.sparkSession
    least = percent / 100
    base = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("tie"), F.xxhash64(F.col(doc_id), F.col(text)).alias("row"), F.col(text).alias("text"))

    def prints(batches):
        total = np.zeros(ORDER_CELLS, "<u4")
        none = lambda k, kind: pa.nulls(k, kind)
        for b, found in _sets(batches, n):
            np.add.at(total, (np.concatenate(found) >> np.uint64(44)).astype(np.int64), 1)
            m = len(found)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "tie": b.column("tie"), "row": b.column("row"), "n_shingles": pa.array([len(s) for s in found], pa.int64()), "class": pa.array([_print(s) for s in found], pa.int64()),
                "i": none(m, pa.int32()), "part": none(m, pa.binary()),
            })
        pack = zstandard.ZstdCompressor(level=1)
        for i, part in enumerate(total.reshape(SEGMENTS, -1)):
            yield pa.RecordBatch.from_pydict({
                **{c: none(1, pa.int64()) for c in ("doc_id", "tie", "row", "n_shingles", "class")}, "i": pa.array([i], pa.int32()), "part": pa.array([pack.compress(part.tobytes())], pa.binary()),
            })

    scanned = staged(base.mapInArrow(prints, "doc_id bigint, tie bigint, row bigint, n_shingles bigint, class bigint, i int, part binary"))
    members = scanned.where("i is null").drop("i", "part")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")
    classes = members.where("n_shingles > 0").groupBy("class").agg(F.min("row").alias("speaker"), F.any_value("n_shingles").alias("size"))
    levels = _levels(scanned.where("i is not null").select("i", "part"))
    shards = max(1, -(-(members.agg(F.sum("n_shingles")).first()[0] or 0) // SHARD_SHINGLES))

    def prefixes(batches):
        """Prefix shingles, packed for the shard that holds their index lists. Of copies within a task one speaks for all."""
        seen = set()
        for _, found in _sets(batches, n):
            fresh = []
            for s in found:
                if len(s) and (name := _print(s)) not in seen:
                    seen.add(name)
                    fresh.append(s)
            found = fresh
            if not found:
                continue
            own = [_ordered(s, levels)[: prefix_length(len(s), least)] for s in found]
            counts = [len(o) for o in own]
            tokens = np.concatenate(own)
            columns = (tokens, np.repeat(np.array([_print(s) for s in found], np.int64), counts), np.repeat(np.array([len(s) for s in found], np.int32), counts), np.concatenate([np.arange(c, dtype=np.int32) for c in counts]))
            shard = (mixed(tokens) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cuts = np.split(order, np.searchsorted(shard[order], np.arange(1, shards)))
            some = [k for k, c in enumerate(cuts) if len(c)]
            yield pa.RecordBatch.from_pydict({"shard": pa.array(some, pa.int32())} | {
                name: pa.array([column[cuts[k]].tobytes() for k in some], pa.binary()) for name, column in zip(LIST, columns)
            })

    def lists(table):
        """The index lists of a shard that more than one class is on."""
        token, own, size, at = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in LIST.items())
        order = np.lexsort((own, token))
        token, own, size, at = token[order], own[order], size[order], at[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (own[1:] != own[:-1])  # copies give the same entry
        token, own, size, at = token[new], own[new], size[new], at[new]
        _, which, length = np.unique(token, return_inverse=True, return_counts=True)
        some = length[which] > 1
        return pa.table({"token": pa.array(token[some].view(np.int64)), "class": pa.array(own[some]), "size": pa.array(size[some]), "at": pa.array(at[some])})

    index = base.select("text").mapInArrow(prefixes, "shard int, token binary, class binary, size binary, at binary").groupBy("shard").applyInArrow(lists, "token bigint, class bigint, size int, at int")

    # blocks of sizes: sets that link lie in the same block or in neighbouring ones
    span = math.log(1 / least) if least < 1 else 1.0
    shared = staged(index.withColumn("block", F.floor(F.log(F.col("size")) / span + 1e-9).cast("int")))
    # the pivot has the fewest rarer shingles: of a group of near copies, one near the middle
    pivot = shared.groupBy("token", "block").agg(F.min(F.struct("at", "class", "size")).alias("p")).select("token", F.col("block").alias("p_block"), "p")
    need = lambda x, y: F.ceil((F.col(x) + F.col(y)) * F.lit(least / (1 + least)) - 1e-9)

    def can_link(x: str, y: str) -> Column:
        """Whether two entries may have the similarity if this is the first shingle that they share, as it is on one list of theirs."""
        (sx, sy), (ax, ay) = ((F.col(x + name), F.col(y + name)) for name in ("size", "at"))
        return (F.least(sx, sy) >= F.greatest(sx, sy) * F.lit(least) - 1e-9) & (F.least(sx - ax, sy - ay) >= need(x + "size", y + "size"))

    near = shared.withColumn("p_block", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1))).join(pivot, ["token", "p_block"])
    first = (
        near.where("class <> p.class").where(can_link("", "p."))
        .select(F.least("class", "p.class").alias("a"), F.greatest("class", "p.class").alias("b")).distinct()
    )
    first = staged(first)
    bodies = _bodies(_ends(first), base, classes, n)
    known = staged(_compared(first, bodies))
    linked = F.col("inter") * 100 >= F.lit(percent) * (F.col("size_a") + F.col("size_b") - F.col("inter"))

    def grouped(edges: DataFrame) -> DataFrame:
        if not edges.head(1):
            return spark.createDataFrame([], "class bigint, root bigint")
        return connected_components(edges, "a", "b").select(F.col("member_id").alias("class"), F.col("entity_id").alias("root"))

    roots = staged(grouped(known.where(linked).select("a", "b")))
    rooted = shared.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    split = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
    distance = known.select("a", "b", (1 - F.col("inter") / (F.col("size_a") + F.col("size_b") - F.col("inter"))).alias("d"))
    both = distance.unionByName(distance.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))
    to_pivot = rooted.join(split, "token").join(pivot.select("token", F.col("p_block").alias("block"), F.col("p.class").alias("pivot")), ["token", "block"]).join(
        both.select(F.col("a").alias("class"), F.col("b").alias("pivot"), "d"), ["class", "pivot"], "left"
    ).withColumn("d", F.when(F.col("class") == F.col("pivot"), F.lit(0.0)).otherwise(F.col("d")))
    carried = ("class", "size", "at", "root", "pivot", "d")
    x = to_pivot.select("token", "block", *[F.col(c).alias(f"x_{c}") for c in carried])
    y = to_pivot.select("token", F.explode(F.array(F.col("block"), F.col("block") - 1)).alias("block"), F.col("block").alias("y_block"), *[F.col(c).alias(f"y_{c}") for c in carried])
    bound = 1 - least + 1e-9
    apart = (F.col("x_pivot") == F.col("y_pivot")) & (F.abs(F.col("x_d") - F.col("y_d")) > bound)
    left_over = (
        x.join(y, ["token", "block"]).where("x_root <> y_root").where((F.col("block") < F.col("y_block")) | (F.col("x_class") < F.col("y_class")))
        .where(can_link("x_", "y_")).where(~F.coalesce(apart, F.lit(False)))
        .select(F.least("x_class", "y_class").alias("a"), F.greatest("x_class", "y_class").alias("b")).distinct()
        .join(known.select("a", "b"), ["a", "b"], "left_anti")
    )
    left_over = staged(left_over)
    if left_over.head(1):
        new = _ends(left_over).join(bodies.select("class"), "class", "left_anti")
        more = staged(_compared(left_over, bodies.unionByName(_bodies(new, base, classes, n))))
        edges = known.where(linked).select("a", "b").union(more.where(linked).select("a", "b"))
        roots = staged(grouped(edges))
    of_class = classes.select("class").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    first_of = members.where("n_shingles > 0").groupBy("class").agg(F.min(place).alias("f")).join(of_class, "class").groupBy("root").agg(F.min("f").alias("f"))
    answer = of_class.join(first_of, "root").select(F.col("class").alias("class_id"), "f")
    full = members.where("n_shingles > 0").withColumnRenamed("class", "class_id").join(answer, "class_id").select(
        "doc_id", "tie", "n_shingles", F.col("f.doc_id").alias("component_id"), "class_id",
        (F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("tie") == F.col("f.tie"))).alias("first"),
    )
    empty = members.where("n_shingles = 0").select("doc_id", "tie", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("bigint").alias("class_id"), F.lit(True).alias("first"))
    return full.unionByName(empty)
