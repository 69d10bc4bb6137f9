"""Phrase collocations by direct-address tiling of frequency-ranked word ids.

Texts are packed into chunks of one language each and become word ids, ranked by frequency
within the language, so that frequent words have small ids. The plane of (left id, right id) is
cut into tiles: 1,024 ids wide at first, and twice as wide as before from there on, because what is
rarer fills less; in large languages tiles are sliced by their left ids too. A chunk counts its
neighbouring pairs tile by tile, and a tile's counts meet in one stream: a tile that is full enough
is added up in a dense array addressed by the pair (``numpy.bincount`` within a chunk), a sparse
one as sorted coordinates. Pairs found often enough are ranked and get ids themselves; (pair id,
next word id) is counted in the same way, and so on for longer phrases. A phrase can only be
frequent if all its parts are, so nothing else is ever looked at.

No task holds more than a chunk or a tile. Chunks do not hold a dictionary of the corpus:
they ask for the ids of their own distinct words and pairs. A tile that lies in very many
chunks is added up in rounds of FAN chunks. Everything that comes after the counts is joins
and exact decimals in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listwell.llm.common import numbered, pieces, staged, texts

#: What ends a piece of text; fixed by the operator's contract.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
FOLD = bytes.maketrans(UPPER + SEPARATORS + b"\t", UPPER.lower() + b"\n" * len(SEPARATORS) + b" ")
CHUNK_BYTES, SLICE_BYTES = 10_000_000, 1_000_000
#: Ids of one language and length are below 2^32. Bands begin at 0, 1,024, 2,048, 4,096, …
MOST_IDS, FIRST_BITS = 1 << 32, 10
BANDS = np.array([0, *[1 << b for b in range(FIRST_BITS, 32)]], np.uint64)
WIDTHS = np.array([1 << FIRST_BITS, *[1 << b for b in range(FIRST_BITS, 32)]], np.uint64)
#: Words of a language per slice of its tiles; cells up to which a tile may be a dense array.
SLICE_WORDS, MOST_CELLS = 1 << 26, 1 << 22
COMPACT_FROM = 1 << 21
FAN = 256

CHUNKS = "chunk bigint, lang string, vocab array<string>, counts array<bigint>, seq binary"
ENCODED = "chunk bigint, lang string, slices bigint, ids binary"
TILES = "lang string, tile bigint, chunk bigint, pairs binary, counts binary"
COUNTED = "lang string, l bigint, r bigint, a bigint"
ANSWERS = "chunk bigint, words int, pairs binary, ids binary"


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()), "array<bigint>": pa.list_(pa.int64())}
    names, types = zip(*(field.split(" ") for field in schema.split(", ")))
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, kinds[t]) for c, t in zip(columns, types)], list(names))


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class _Chunk:
    """Words of one language; 0 stands for the end of a piece, 1 for what lies between two spaces."""

    def __init__(self):
        self.index, self.parts, self.size = _Numbers({b"\n": 0, b"": 1}), [], 0

    def add(self, text: bytes) -> None:
        found = text.replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.index.__getitem__, found), np.int32, len(found))
        self.parts.append(ids[ids != 1])
        self.size += len(text)

    def row(self, number: int, lang: str) -> pa.RecordBatch:
        seq = np.concatenate(self.parts)
        vocab = pa.array(list(self.index)[2:], pa.binary()).cast(pa.string())
        counts = np.bincount(seq, minlength=len(self.index))[2:]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(vocab)], pa.int32()), x) for x in (vocab, pa.array(counts, pa.int64()))]
        return _batch(CHUNKS, [[number], [lang], *lists, [_packed(np.where(seq == 0, -1, seq - 2).astype(np.int32))]])


def _slices(text: bytes) -> Iterator[bytes]:
    """A text in parts of some SLICE_BYTES that end between words."""
    start = 0
    while start < len(text):
        end = start + SLICE_BYTES
        if end < len(text):
            ends = [e for e in (text.find(b" ", end), text.find(b"\n", end)) if e >= 0]
            end = min(ends) + 1 if ends else len(text)
        yield text[start:end]
        start = end


def _to_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, done, held = TaskContext.get().partitionId(), 0, {}
    for batch in pieces(batches, "text"):
        for lang, text in zip(batch.column("lang").to_pylist(), texts(batch, "text")):
            for part in _slices(text.translate(FOLD) + b"\n"):
                held.setdefault(lang, _Chunk()).add(part)
                # A chunk ends only where a piece does. The largest goes when all are too large together.
                if part.endswith(b"\n") and sum(c.size for c in held.values()) >= CHUNK_BYTES:
                    name = max(held, key=lambda x: held[x].size)
                    yield held.pop(name).row(task << 33 | done, name)
                    done += 1
    for name, chunk in held.items():
        yield chunk.row(task << 33 | done, name)
        done += 1


def _chunks(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return staged(rows.mapInArrow(_to_chunks, CHUNKS))


def _ranked(counted: DataFrame, name: list[str]) -> DataFrame:
    """Adds ``id``: rank by count within the language, from 0; equal counts by the columns ``name``."""
    placed = numbered(counted, ["lang", F.desc("a"), *name])
    first = placed.groupBy("lang").agg(F.min("number").alias("first"), F.count("*").alias("ids"))
    placed = placed.join(first, "lang").withColumn("id", F.col("number") - F.col("first"))
    fits = F.when(F.col("ids") <= MOST_IDS, F.col("id")).otherwise(F.raise_error(F.lit("more than 2^32 frequent phrases of one language")))
    return placed.withColumn("id", fits.cast("bigint")).drop("number", "first", "ids")


def _encoded(chunks: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """Chunks as word ids, with the number of slices of their language; -1 stands for rare words and for ends of pieces."""
    asked = chunks.select("chunk", "lang", F.posexplode("vocab").alias("at", "word"))
    known = asked.join(words.select("lang", "word", "id"), ["lang", "word"]).select(F.col("chunk").alias("chunk"), "at", "id")

    def encode(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for chunk, lang, slices, seq in zip(*(left.column(c).to_pylist() for c in ("chunk", "lang", "slices", "seq"))):
            local = _unpacked(seq, np.int32)
            ids = np.full(int(local.max(initial=-1)) + 2, -1, np.int64)
            ids[right.column("at").to_numpy()] = right.column("id").to_numpy()
            rows.append((chunk, lang, slices, _packed(ids[local])))  # -1 takes the last, which is -1
        return pa.Table.from_batches([_batch(ENCODED, list(zip(*rows)) if rows else [[]] * 4)])

    slices = totals.select("lang", F.expr(f"1 + n div {SLICE_WORDS}").alias("slices"))
    seqs = chunks.select("chunk", "lang", "seq").join(slices, "lang")
    return staged(seqs.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(encode, ENCODED))


def _pair_keys(symbols: np.ndarray, ids: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, pairs) of phrases of ``words`` + 1 words; ``symbols`` are ids of those of ``words`` words by place.

    A pair is one number: left id, then right id.
    """
    n = len(ids) - words
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero((symbols[:n] >= 0) & (symbols[1 : n + 1] >= 0) & (ids[words:] >= 0))
    return at, symbols[at].astype(np.uint64) << np.uint64(32) | ids[at + words].astype(np.uint64)


def _halves(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)


def _counted_pairs(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order with their counts; those of the first tile, the fullest by far, by bincount."""
    left, right = _halves(pairs)
    first = (left < WIDTHS[0]) & (right < WIDTHS[0])
    cells = int(WIDTHS[0]) ** 2
    if np.count_nonzero(first) < cells // 8:
        return np.unique(pairs, return_counts=True)
    dense = np.bincount((left[first] << np.uint64(FIRST_BITS) | right[first]).astype(np.int64), minlength=cells)
    full = np.flatnonzero(dense)
    own = (full >> FIRST_BITS).astype(np.uint64) << np.uint64(32) | (full & (1 << FIRST_BITS) - 1).astype(np.uint64)
    others, counts = np.unique(pairs[~first], return_counts=True)
    found, counts = np.concatenate([own, others]), np.concatenate([dense[full], counts])
    order = np.argsort(found, kind="stable")
    return found[order], counts[order]


def _tile_of(pairs: np.ndarray, slices: int) -> np.ndarray:
    """Band of the left id, band of the right id, slice of the left band, as one number. The first tile has one slice."""
    left, right = _halves(pairs)
    a, b = (np.searchsorted(BANDS, x, side="right") - 1 for x in (left, right))
    part = ((left - BANDS[a]) * np.uint64(slices) // WIDTHS[a]).astype(np.int64)
    return (a << 5 | b) << 32 | np.where((a == 0) & (b == 0), 0, part)


def _tile_rows(chunk: int, lang: str, slices: int, pairs: np.ndarray) -> pa.RecordBatch:
    pairs, counts = _counted_pairs(pairs)
    tiles = _tile_of(pairs, slices)
    order = np.argsort(tiles, kind="stable")  # pairs stay in order within a tile
    pairs, counts, tiles = pairs[order], counts[order].astype(np.uint32), tiles[order]
    starts = np.flatnonzero(np.diff(tiles, prepend=-1))
    ends = [*starts[1:], len(tiles)]
    rows = [(int(tiles[s]), _pairs_out(pairs[s:e]), _packed(counts[s:e])) for s, e in zip(starts, ends)]
    n = len(rows)
    return _batch(TILES, [[lang] * n, [r[0] for r in rows], [chunk] * n, [r[1] for r in rows], [r[2] for r in rows]])


def _pairs_out(pairs: np.ndarray) -> bytes:
    """Sorted pairs as differences, which compress well."""
    return _packed(np.diff(pairs, prepend=np.uint64(0)))


def _pairs_in(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint64), dtype=np.uint64)


def _symbols(ids: np.ndarray, answers: pa.Table, words: int) -> np.ndarray:
    """Ids of the phrases of ``words`` words by place, from the answers for 2, 3, … words; -1 where there is none."""
    symbols, length = ids, np.asarray(answers.column("words"))
    for level in range(2, words + 1):
        own = answers.filter(pa.array(length == level))
        next_symbols = np.full(len(ids), -1, np.int64)
        if own.num_rows:
            known = np.concatenate([_pairs_in(c) for c in own.column("pairs").to_pylist()])
            named = np.concatenate([_unpacked(i, np.int64) for i in own.column("ids").to_pylist()])
            order = np.argsort(known)
            known, named = known[order], named[order]
            at, pairs = _pair_keys(symbols, ids, level - 1)
            place = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
            next_symbols[at] = np.where(known[place] == pairs, named[place], -1)
        symbols = next_symbols
    return symbols


def _tiles(encoded: DataFrame, answers: DataFrame | None, words: int) -> DataFrame:
    """Per chunk and tile: the pairs that make phrases of ``words`` + 1 words, and how often each is there."""
    own = ("chunk", "lang", "slices", "ids")
    if words == 1:

        def alone(batches):
            for batch in batches:
                for chunk, lang, slices, data in zip(*(batch.column(c).to_pylist() for c in own)):
                    ids = _unpacked(data, np.int64)
                    yield _tile_rows(chunk, lang, slices, _pair_keys(ids, ids, 1)[1])

        return encoded.mapInArrow(alone, TILES)

    def longer(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        for chunk, lang, slices, data in zip(*(left.column(c).to_pylist() for c in own)):
            ids = _unpacked(data, np.int64)
            found.append(_tile_rows(chunk, lang, slices, _pair_keys(_symbols(ids, right, words), ids, words)[1]))
        return pa.Table.from_batches(found or [_batch(TILES, [[]] * 5)])

    return encoded.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(longer, TILES)


class _Tile:
    """Counts of one tile: sorted coordinates while it is sparse, an array with a cell for each pair once it is full enough."""

    def __init__(self, tile: int):
        a, b = tile >> 37, tile >> 32 & 31
        self.left, self.right, self.width = int(BANDS[a]), int(BANDS[b]), int(WIDTHS[b])
        self.area = int(WIDTHS[a]) * self.width
        self.pairs, self.counts, self.entries, self.dense = [], [], 0, None

    def _cells(self, pairs: np.ndarray) -> np.ndarray:
        left, right = _halves(pairs)
        return (left.astype(np.int64) - self.left) * self.width + right.astype(np.int64) - self.right

    def add(self, pairs: np.ndarray, counts: np.ndarray) -> None:
        if self.dense is not None:
            self.dense[self._cells(pairs)] += counts  # a row has a pair once
            return
        self.pairs.append(pairs)
        self.counts.append(counts.astype(np.int64))
        self.entries += len(pairs)
        if self.area <= MOST_CELLS and self.entries > self.area // 8:
            dense = np.zeros(self.area, np.int64)
            for p, n in zip(self.pairs, self.counts):
                dense[self._cells(p)] += n
            self.pairs, self.counts, self.dense = [], [], dense
        elif self.entries > COMPACT_FROM and len(self.pairs) > 1 and self.entries > 2 * len(self.pairs[0]):
            pairs, counts = self.totals()
            self.pairs, self.counts, self.entries = [pairs], [counts], len(pairs)

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        if self.dense is not None:
            cells = np.flatnonzero(self.dense)
            left, right = cells // self.width + self.left, cells % self.width + self.right
            return left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64), self.dense[cells]
        pairs, counts = np.concatenate(self.pairs), np.concatenate(self.counts)
        order = np.argsort(pairs, kind="stable")
        pairs, counts = pairs[order], counts[order]
        starts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(pairs) else np.zeros(0, np.int64)
        return pairs[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _merged(tiles: DataFrame, chunks: int, least: int) -> DataFrame:
    """(lang, l, r, a) of all pairs of ids found ``least`` times or more, from the chunks' tiles.

    Rounds add up to FAN rows of a tile each, the last one all that are left.
    """

    def streams(batches, finish):
        key, tile = None, None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("lang", "tile", "salt", "whole", "pairs", "counts")))
            for lang, number, salt, whole, pairs, counts in rows:
                if (lang, number, salt) != key:
                    if tile is not None:
                        yield finish(key, *tile.totals())
                    key, tile = (lang, number, salt), _Tile(number)
                tile.add(_pairs_in(pairs), _unpacked(counts, np.int64 if whole else np.uint32))
        if tile is not None:
            yield finish(key, *tile.totals())

    def partial(batches):
        yield from streams(batches, lambda key, pairs, counts: _batch(TILES, [[key[0]], [key[1]], [key[2]], [_pairs_out(pairs)], [_packed(counts)]]))

    def final(batches):
        def finish(key, pairs, counts):
            often = counts >= least
            left, right = _halves(pairs[often])
            return _batch(COUNTED, [[key[0]] * len(left), left.astype(np.int64), right.astype(np.int64), counts[often]])

        yield from streams(batches, finish)

    def dealt(rows, salts, whole):
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts))).withColumn("whole", F.lit(whole))
        by = ["lang", "tile", "salt"]
        return salted.repartition(*by).sortWithinPartitions(*by).select(*by, "whole", "pairs", "counts")

    whole = False
    while chunks > FAN:
        chunks = -(-chunks // FAN)
        tiles, whole = dealt(tiles, chunks, whole).mapInArrow(partial, TILES), True
    return dealt(tiles, 1, whole).mapInArrow(final, COUNTED)


def _answered(tiles: DataFrame, phrases: DataFrame, encoded: DataFrame, chunks: int, words: int) -> DataFrame:
    """Ids of the frequent phrases of ``words`` words for each chunk that has them, staged.

    A tile's frequent pairs come first in its stream and stay while its chunks pass.
    """
    salt = F.pmod(F.xxhash64("chunk"), F.lit(-(-chunks // FAN) or 1)).alias("salt")
    asking = tiles.select("lang", "tile", salt, "chunk", "pairs")
    where = asking.select("lang", "tile", "salt").distinct()

    @F.pandas_udf("bigint")
    def tile_of(left: pd.Series, right: pd.Series, slices: pd.Series) -> pd.Series:
        pairs = left.to_numpy(np.uint64) << np.uint64(32) | right.to_numpy(np.uint64)
        found = np.zeros(len(pairs), np.int64)
        for n in slices.unique():
            found[slices == n] = _tile_of(pairs[slices == n], int(n))
        return pd.Series(found)

    slices = encoded.select("lang", "slices").distinct()
    known = phrases.join(slices, "lang").select("lang", tile_of("l", "r", "slices").alias("tile"), "l", "r", "id").join(where, ["lang", "tile"])
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    rows = known.select("lang", "tile", "salt", none("bigint", "chunk"), none("binary", "pairs"), "l", "r", "id").unionByName(
        asking.select("lang", "tile", "salt", "chunk", "pairs", none("bigint", "l"), none("bigint", "r"), none("bigint", "id"))
    )
    rows = rows.repartition("lang", "tile", "salt").sortWithinPartitions("lang", "tile", "salt", F.asc_nulls_first("chunk"), "l", "r")

    def answer(batches):
        key, pairs_known, ids_known, table = None, [], [], None
        for batch in batches:
            numbers = batch.column("chunk")
            asks = numbers.is_valid().to_numpy(zero_copy_only=False)
            # Runs of rows of one kind and tile.
            kinds = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "tile", "salt")), asks.tolist()))
            starts = [i for i, kind in enumerate(kinds) if i == 0 or kind != kinds[i - 1]]
            out = []
            for start, end in zip(starts, [*starts[1:], len(kinds)]):
                if kinds[start][:3] != key:
                    key, pairs_known, ids_known, table = kinds[start][:3], [], [], None
                if not asks[start]:
                    left, right, ids = (batch.column(c).slice(start, end - start).to_numpy() for c in ("l", "r", "id"))
                    pairs_known.append(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64))
                    ids_known.append(ids)
                    continue
                if not pairs_known:
                    continue
                if table is None:
                    table = np.concatenate(pairs_known), np.concatenate(ids_known)
                for i in range(start, end):
                    pairs = _pairs_in(batch.column("pairs")[i].as_py())
                    place = np.minimum(np.searchsorted(table[0], pairs), len(table[0]) - 1)
                    hit = table[0][place] == pairs
                    if hit.any():
                        out.append((numbers[i].as_py(), words, _pairs_out(pairs[hit]), _packed(table[1][place[hit]])))
            if out:
                yield _batch(ANSWERS, list(zip(*out)))

    return staged(rows.mapInArrow(answer, ANSWERS))


def phrase_counts(docs: DataFrame, max_words: int = 3, least: int = 10) -> tuple[DataFrame, list[DataFrame]]:
    """(totals, levels): (lang, n) words of each language, and for 1, 2, … words the frequent phrases.

    A level holds (lang, id, phrase, last, a, prefixes, suffixes, prefix, suffix): the count, the counts of
    what stands before and after each cut, and the ids of the phrase without its last and its first word.
    """
    chunks = _chunks(docs)
    n_chunks = chunks.count()
    listed = chunks.select("lang", F.inline(F.arrays_zip("vocab", "counts"))).groupBy("lang", F.col("vocab").alias("word")).agg(F.sum("counts").alias("a"))
    totals = chunks.select("lang", F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    words = _ranked(listed.where(F.col("a") >= least), ["word"])
    encoded = _encoded(chunks, words, totals)
    nothing, no_id = F.array().cast("array<bigint>"), F.lit(None).cast("bigint")
    level = words.select("lang", "id", F.col("word").alias("phrase"), F.col("word").alias("last"), "a", nothing.alias("prefixes"), nothing.alias("suffixes"), no_id.alias("prefix"), no_id.alias("suffix"))
    levels, pairs, answers = [level], None, None
    for length in range(2, max_words + 1):
        tiles = _tiles(encoded, answers, length - 1)
        found = _ranked(_merged(tiles, n_chunks, least), ["l", "r"])
        before = levels[-1].select("lang", F.col("id").alias("l"), F.col("phrase").alias("l_phrase"), F.col("a").alias("l_a"), F.col("prefixes").alias("l_prefixes"), F.col("suffix").alias("l_suffix"))
        rows = found.join(before, ["lang", "l"])
        # What is left without the first word: the last word, or the phrase of that phrase's rest and the last word.
        if length == 2:
            rest = F.col("r")
        else:
            rows = rows.join(pairs.select("lang", F.col("l").alias("l_suffix"), "r", F.col("id").alias("rest")), ["lang", "l_suffix", "r"])
            rest = F.col("rest")
        after = levels[-1].select("lang", F.col("id").alias("suffix"), F.col("last"), F.col("a").alias("s_a"), F.col("suffixes").alias("s_suffixes"))
        rows = rows.withColumn("suffix", rest).join(after, ["lang", "suffix"])
        level = rows.select(
            "lang", "id", F.concat_ws(" ", "l_phrase", "last").alias("phrase"), "last", "a", F.concat("l_prefixes", F.array("l_a")).alias("prefixes"),
            F.concat(F.array("s_a"), "s_suffixes").alias("suffixes"), F.col("l").alias("prefix"), "suffix",
        )
        levels.append(staged(level))
        pairs = found
        if length < max_words:
            own = _answered(tiles, found, encoded, n_chunks, length)
            answers = own if answers is None else answers.unionByName(own)
    return totals, levels


def collocations(docs: DataFrame, max_words: int = 3, least: int = 10, percent: int = 50) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): every phrase that is kept, unranked.

    Words are what lies between spaces and tabs of a piece, pieces what lies between separators; A-Z are folded.
    A null lang counts as ``und``, a null text as empty. A phrase is scored at its lowest cut, ties going
    to the first, in exact decimals. It is left out if a phrase one word longer that holds it is found
    in ``percent`` of its cases or more (one that is longer still is never found more often). Repeated rows count again.
    """
    totals, levels = phrase_counts(docs, max_words, least)
    exact = lambda x: x.cast("decimal(19,0)")
    times = F.lit(1_000_000).cast("decimal(7,0)") * exact(F.col("a")) * exact(F.col("a"))
    kept = []
    for i, level in enumerate(levels[1:], 1):
        cuts = F.transform(
            F.arrays_zip("prefixes", "suffixes"), lambda c, k: F.struct(
                F.call_function("div", times, exact(c["prefixes"]) * exact(c["suffixes"])).alias("score"), k.alias("k"),
                c["prefixes"].alias("l"), c["suffixes"].alias("r"),
            )
        )
        rows = level.withColumn("cut", F.array_min(cuts))
        if i + 1 < len(levels):
            longer = levels[i + 1].select("lang", F.explode(F.array("prefix", "suffix")).alias("id"), "a").groupBy("lang", "id").agg(F.max("a").alias("longer"))
            rows = rows.join(longer, ["lang", "id"], "left").where(f"longer IS NULL OR 100 * CAST(longer AS decimal(19,0)) < {percent} * CAST(a AS decimal(19,0))")
        kept.append(rows.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    found = kept[0]
    for more in kept[1:]:
        found = found.unionByName(more)
    return found.join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))


def best_per_language(found: DataFrame, top: int = 2000) -> DataFrame:
    """The first ``top`` rows of each language by score, count and phrase, with ``rank`` from 1.

    Parts of a language are cut to ``top`` rows each before they meet.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top).drop("part")
