"""Near-duplicate vectors by exact cosine: tiles compared in PCA order with early stops.

Equal vectors become one row with a count. All others are rotated onto the principal axes
of all rows, which keeps every product, and sorted into cells of the first axes that are as
wide as two linked vectors can be apart. Cells are cut into tiles of bounded size; a tile
meets only the tiles of neighbouring cells whose boxes are near enough. Inside a pair of
tiles products are accumulated over leading axes; what the rest can add is at most the
product of the suffix norms, and a pair is given up once that cannot reach the threshold.
A tile pair returns link counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwell.operators.components import connected_components
from listwell.session import cut_lineage

GRID = 3
BLOCKS = (4, 8, 16, 32)
SLACK = 1e-9


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows, filled up with zeros on the right."""
    out = np.zeros((len(column), width))
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = np.repeat(np.arange(len(column)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _axes(distinct: DataFrame, width: int) -> np.ndarray:
    """Principal axes of all rows: width x width sums, added up in Spark."""

    def sums(batches):
        total, n = np.zeros((width, width)), 0
        for b in batches:
            u = _unit(_matrix(b.column("v"), width))
            total += u.T @ u
            n += len(u)
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(width), pa.int32()), "row": list(total)})

    parts = distinct.select("v").mapInArrow(sums, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    moments = np.zeros((width, width))
    for c in cells:  # width squared numbers, whatever the number of rows
        moments[c.i, c.j] = c.x
    return np.linalg.eigh((moments + moments.T) / 2)[1][:, ::-1].copy()


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their greatest component near 1: exact, and squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def links_between(a, b, raw_a, raw_b, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of pairs with cosine >= threshold; a and b are unit rows in PCA order."""
    raw_a, raw_b = _scaled(raw_a), _scaled(raw_b)
    width = a.shape[1]
    cuts = [c for c in BLOCKS if c < width] + [width]
    tail = lambda m, c: np.sqrt((m[:, c:] ** 2).sum(axis=1))
    part = a[:, : cuts[0]] @ b[:, : cuts[0]].T
    alive = part + np.outer(tail(a, cuts[0]), tail(b, cuts[0])) >= threshold - SLACK
    if same:
        alive = np.triu(alive, 1)
    x, y = np.nonzero(alive)
    acc = part[x, y]
    for lo, hi in zip(cuts, cuts[1:]):
        if not len(x):
            break
        ta, tb, keep, sums = tail(a, hi), tail(b, hi), [], []
        for s in range(0, len(x), 100_000):  # bounded memory
            i, j = x[s : s + 100_000], y[s : s + 100_000]
            got = acc[s : s + 100_000] + np.einsum("ij,ij->i", a[i, lo:hi], b[j, lo:hi])
            fine = got + ta[i] * tb[j] >= threshold - SLACK
            keep.append(fine)
            sums.append(got[fine])
        fine = np.concatenate(keep)
        x, y, acc = x[fine], y[fine], np.concatenate(sums)
    sure = []
    norm_a, norm_b = np.sqrt((raw_a**2).sum(axis=1)), np.sqrt((raw_b**2).sum(axis=1))
    for s in range(0, len(x), 100_000):
        i, j = x[s : s + 100_000], y[s : s + 100_000]
        sure.append(np.einsum("ij,ij->i", raw_a[i], raw_b[j]) / (norm_a[i] * norm_b[j]) >= threshold)
    fine = np.concatenate(sure) if sure else np.zeros(0, bool)
    return x[fine], y[fine]


def _forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node that it is connected with."""
    low = np.arange(n)
    while len(x):
        least = np.minimum(low[x], low[y])
        before = low.copy()
        np.minimum.at(low, x, least)
        np.minimum.at(low, y, least)
        low = low[low]
        if (low == before).all():
            break
    return low


def near_vectors(
    vectors: DataFrame, threshold: float = 0.98, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    tile_rows: int = 1024,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Two rows link if their labels are equal and not null, their vectors have as many
    components and their cosine in double precision is at least ``threshold``. Null, empty
    and zero vectors, and those with null or non-finite components, link with nothing.
    ``component_id`` is the least vec_id that links reach; a row that links with nothing is
    its own component. Rows that share a vec_id count as vectors of their own; a null vec_id
    is least only among nulls. Other columns are left out.
    """
    spark = vectors.sparkSession
    v = F.transform(F.col(embedding), lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).alias("label"), v.alias("v"))
    sound = (
        F.col("label").isNotNull() & F.col("v").isNotNull() & F.exists("v", lambda x: x != 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    rows = rows.withColumn("key", F.when(F.col("sound"), F.sha2(F.concat_ws("|", F.lit("k"), F.col("label").cast("string"), F.concat_ws(",", F.transform("v", lambda x: x.cast("string")))), 256)))
    classes = cut_lineage(
        rows.where("sound").groupBy("key").agg(
            F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.any_value("label").alias("label"), F.any_value("v").alias("v")
        ).withColumn("id", F.monotonically_increasing_id())
    )
    width = classes.agg(F.max(F.size("v"))).first()[0]
    empty = rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not width:
        return empty
    axes, radius = _axes(classes, width), math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    grid = min(GRID, width)
    cells = [f"c{g}" for g in range(GRID)]

    def place(batches):
        for b in batches:
            u = _unit(_matrix(b.column("v"), width)) @ axes
            at = np.floor(u[:, :grid] / radius).astype(np.int32)
            cols = {"id": b.column("id"), "copies": b.column("copies"), "label": b.column("label"), "dims": pa.array(np.diff(b.column("v").offsets.to_numpy()).astype(np.int32)), "v": b.column("v")}
            yield pa.RecordBatch.from_pydict(cols | {c: pa.array(at[:, g] if g < grid else np.zeros(len(u), np.int32)) for g, c in enumerate(cells)})

    kind = classes.schema["label"].dataType.simpleString()
    placed = classes.select("id", "copies", "label", "v").mapInArrow(
        place, f"id bigint, copies bigint, label {kind}, dims int, v array<double>, c0 int, c1 int, c2 int"
    )
    key = ["label", "dims", *cells]

    def cut(batches):
        """Rows of a cell, which come one after another, as tiles of at most tile_rows."""
        held, at = [], None

        def tile():
            raw = np.array([r[2] for r in held])
            full = np.zeros((len(held), width))
            full[:, : raw.shape[1]] = raw
            u = _unit(full) @ axes
            return pa.RecordBatch.from_pydict({k: [x] for k, x in zip(key, at)} | {
                "ids": [np.array([r[0] for r in held], np.int64).tobytes()], "m": [np.array([r[1] for r in held], np.int64).tobytes()],
                "raw": [full.tobytes()], "box": [np.concatenate([u.min(axis=0)[:16], u.max(axis=0)[:16]]).tolist()],
            }, schema=pa.schema([(k, placed_types[k]) for k in key] + [("ids", pa.binary()), ("m", pa.binary()), ("raw", pa.binary()), ("box", pa.list_(pa.float64()))]))

        placed_types = {}
        for b in batches:
            placed_types = {f.name: f.type for f in b.schema}
            where = list(zip(*[b.column(k).to_pylist() for k in key]))
            for w, i, m, v in zip(where, b.column("id").to_pylist(), b.column("copies").to_pylist(), b.column("v").to_numpy(zero_copy_only=False)):
                if held and (w != at or len(held) >= tile_rows):
                    yield tile()
                    held = []
                at = w
                held.append((i, m, v))
        if held:
            yield tile()

    tiles = cut_lineage(
        placed.repartitionByRange(*key, "id").sortWithinPartitions(*key, "id")
        .mapInArrow(cut, f"label {kind}, dims int, c0 int, c1 int, c2 int, ids binary, m binary, raw binary, box array<double>")
        .withColumn("tile", F.monotonically_increasing_id())
    )
    slim = tiles.select("tile", "box", *key)
    shifts = F.array(*[F.struct(*[F.lit(d).alias(f"d{g}") for g, d in enumerate(step)]) for step in product((-1, 0, 1), repeat=GRID)])
    there = slim.select(F.col("tile").alias("a"), F.col("box").alias("box_a"), "label", "dims", *cells, F.explode(shifts).alias("s")).select(
        "a", "box_a", "label", "dims", *[(F.col(c) + F.col(f"s.d{g}")).alias(c) for g, c in enumerate(cells)]
    )
    half = F.size("box") / 2
    gap = F.aggregate(
        F.sequence(F.lit(1), half.cast("int")), F.lit(0.0),
        lambda acc, i: acc + F.pow(F.greatest(
            F.lit(0.0), F.element_at("box", i) - F.element_at("box_a", (i + half).cast("int")), F.element_at("box_a", i) - F.element_at("box", (i + half).cast("int"))
        ), 2),
    )
    pairs = there.join(slim, key).where("a <= tile").where(gap <= radius**2).select("a", F.col("tile").alias("b"))
    body = tiles.select("tile", "ids", "m", "raw")
    met = (
        pairs.join(body.select(F.col("tile").alias("a"), F.col("ids").alias("ids_a"), F.col("m").alias("m_a"), F.col("raw").alias("raw_a")), "a")
        .join(body.select(F.col("tile").alias("b"), F.col("ids").alias("ids_b"), F.col("m").alias("m_b"), F.col("raw").alias("raw_b")), "b")
    )

    def compare(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                same = row["a"] == row["b"]
                ids = [np.frombuffer(row[f"ids_{s}"], np.int64) for s in "ab"]
                m = [np.frombuffer(row[f"m_{s}"], np.int64) for s in "ab"]
                raw = [np.frombuffer(row[f"raw_{s}"]).reshape(-1, width) for s in "ab"]
                x, y = links_between(_unit(raw[0]) @ axes, _unit(raw[1]) @ axes, raw[0], raw[1], threshold, same)
                if not len(x):
                    continue
                n_a = len(ids[0])
                if same:
                    node, count, y0 = ids[0], m[0], y
                else:
                    node, count, y0 = np.concatenate(ids), np.concatenate(m), y + n_a
                got = np.bincount(x, weights=count[y0], minlength=len(node)) + np.bincount(y0, weights=count[x], minlength=len(node))
                low = _forest(len(node), x, y0)
                some = np.flatnonzero(got)
                yield pa.RecordBatch.from_pydict({"id": node[some], "low": node[low[some]], "n": got[some].astype(np.int64)})

    found = cut_lineage(met.mapInArrow(compare, "id bigint, low bigint, n bigint"))
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    edges = found.where("id <> low").select(F.col("id").alias("src"), F.col("low").alias("dst")).distinct()
    groups = connected_components(edges) if edges.head(1) else spark.createDataFrame([], "entity_id bigint, member_id bigint")
    of_class = (
        classes.select("id", "key", "low", "copies").join(groups.select(F.col("member_id").alias("id"), "entity_id"), "id", "left")
        .join(counts, "id", "left").withColumn("root", F.coalesce("entity_id", "id"))
    )
    least = of_class.groupBy("root").agg(F.min("low").alias("component_id"))
    answer = of_class.join(least, "root").select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = rows.where("sound").select("vec_id", "key").join(answer, "key").select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("sound")).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
