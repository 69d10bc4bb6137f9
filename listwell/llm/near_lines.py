"""Line dedup by a deletion-neighbourhood join, with words as the unit of edits.

A line is its sequence of words. Two lines are near duplicates if they are equal, or if both
have at least ``min_words`` words and one becomes the other by inserting, deleting or
replacing one word. A line goes if a near duplicate of it comes earlier.

Deleting a word gives a variant, emitted as a hashed key. Lines that give the same variant
by deleting at the same place differ in one word at most; a line that equals a variant of
another is that line without a word. So equality of keys proves the edit bound, and the
earliest line of a key answers for all others: no pairs are made, however many lines share
a key, and the earliest is found by partial aggregates.

Only lines that can have a partner emit variants: of two lines one edit apart, the first or
the last halves (by words of the shorter) are equal, so a line whose halves nobody shares
has none. Hashes of subsequences are polynomial sums over 64-bit hashes of words, and those over bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwell.llm.common import let, mixed, numbered, pieces, staged, texts

MIN_WORDS = 10
EMITTED = 256  # lines in a batch of variants
BASE = 0x9E3779B97F4A7C15 | 1  # an odd number, so that its powers have inverses
UNBASE = pow(BASE, -1, 1 << 64)
NO_ID = (1 << 63) - 1  # null ids come last


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


#: A random number for each byte, and which bytes stand between words.
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
SPACES = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


class Powers:
    """Powers of BASE and of its inverse, as many as were ever needed."""

    def __init__(self):
        self.up, self.down = _powers(BASE, 1 << 16), _powers(UNBASE, 1 << 16)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(self.up):
            self.up, self.down = _powers(BASE, 2 * n), _powers(UNBASE, 2 * n)
        return self.up, self.down


class Lines:
    """The lines of a batch of texts: hashes of words one after another, and where each line starts.

    All texts are looked through as one array of bytes. A word's hash is a polynomial sum over its bytes, so
    no word is made an object.
    """

    def __init__(self, batch_texts: list[bytes], powers: Powers):
        data = np.frombuffer(b"\n".join(batch_texts) + b"\n", np.uint8)
        between = SPACES[data]
        edges = np.flatnonzero(np.diff(between, prepend=True))
        first, last = edges[::2], edges[1::2]  # a line feed ends the array, so every word has an end
        up, down = powers.to(max(len(data), len(first)) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTES[data] * up[: len(data)], dtype=np.uint64)])
        word = mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
        line, self.start = np.unique(np.searchsorted(np.flatnonzero(data == 10), first), return_index=True)
        self.end = np.append(self.start[1:], len(word)) if len(word) else self.start
        ends = np.cumsum([t.count(b"\n") + 1 for t in batch_texts])
        doc = np.searchsorted(ends, line, side="right")
        self.doc, self.number = doc.tolist(), (line - np.concatenate([[0], ends])[doc]).tolist()
        self.up, self.down = up, down
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word * up[: len(word)], dtype=np.uint64)])

    def part(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hashes of the words from lo up to hi, wherever they stand."""
        return (self.sums[hi] - self.sums[lo]) * self.down[lo]

    def whole(self) -> np.ndarray:
        return mixed(self.part(self.start, self.end) + (self.end - self.start).astype(np.uint64))

    def halves(self) -> list[np.ndarray]:
        """Per line four keys: first and last half, by its own length and by one word less."""
        n, out = self.end - self.start, []
        for h in (n // 2, (n - 1) // 2):
            tag = mixed(h.astype(np.uint64))
            out += [mixed(self.part(self.start, self.start + h) ^ tag), mixed(self.part(self.end - h, self.end) ^ ~tag)]
        return out

    def variants(self, line: int) -> np.ndarray:
        """Hashes of the line without its i-th word, for each i."""
        s, e = int(self.start[line]), int(self.end[line])
        at = np.arange(s, e)
        left, right = self.sums[at] - self.sums[s], (self.sums[e] - self.sums[at + 1]) * np.uint64(UNBASE)
        return mixed((left + right) * self.down[s] + np.uint64(e - s - 1))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def dropped_lines(rows: DataFrame, text: str, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, tie, numbers): for each document the numbers of its lines that go.

    ``rows`` has all columns, ``_d`` the id and ``_t`` the rank of the text among the different texts of its id.
    """
    keyed = rows.select(F.col("_d").alias("doc_id"), F.col("_t").alias("tie"), F.col(text).alias("text"))

    def scan(batches):
        powers = Powers()
        for b in pieces(batches, "text"):
            own = Lines(texts(b, "text"), powers)
            if not len(own.start):
                continue
            n, halves = own.end - own.start, own.halves()
            keys = np.stack(halves, axis=1).view(np.int64)
            keys[(n - 1) // 2 == n // 2, 2:] = 0  # the same halves again
            keys[n < min_words] = 0
            at = pa.array(own.doc)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id").take(at), "tie": b.column("tie").take(at), "number": pa.array(own.number, pa.int32()),
                "line": _signed(own.whole()), **{f"k{i}": pa.array(keys[:, i]) for i in range(4)},
            })

    lines = staged(keyed.mapInArrow(scan, "doc_id bigint, tie int, number int, line bigint, k0 bigint, k1 bigint, k2 bigint, k3 bigint"))
    # ids that are null come last; tie and number share one integer, which orders as the two do
    place = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.shiftleft(F.col("tie").cast("bigint"), 32).bitwiseOR(F.col("number")).alias("at"))
    distinct = staged(lines.groupBy("line").agg(F.min(place).alias("first"), *[F.any_value(c).alias(c) for c in ("k0", "k1", "k2", "k3")]))

    halves = distinct.select("line", "first.*", F.explode(F.array("k0", "k1", "k2", "k3")).alias("key")).where("key <> 0")
    shared = halves.groupBy("key").agg(F.min("line").alias("a"), F.max("line").alias("b")).where("a <> b").select("key")
    able = halves.join(shared, "key").groupBy("line").agg(F.any_value("id").alias("id"), F.any_value("at").alias("at"))
    number = F.col("at").bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    wanted = able.groupBy(F.nullif("id", F.lit(NO_ID)).alias("w_id"), F.shiftright("at", 32).cast("int").alias("w_tie")).agg(F.collect_set(number).alias("numbers"))

    def emit(batches, places_too=True):
        powers = Powers()
        unpacked = (pa.RecordBatch.from_arrays([*(b.column(c) for c in (text, "numbers", "_d", "_t"))], ["text", "numbers", "_d", "_t"]) for b in batches)
        for b in pieces(unpacked, "text"):
            own, wanted_of = Lines(texts(b, "text"), powers), [set(x) for x in b.column("numbers").to_pylist()]
            whole, found = own.whole(), [i for i, (d, number) in enumerate(zip(own.doc, own.number)) if number in wanted_of[d]]
            for start in range(0, len(found), EMITTED):
                some, keys, kinds = found[start : start + EMITTED], [], []
                for line in some:
                    v = own.variants(line)
                    places = np.arange(len(v), dtype=np.uint64)
                    # a key without a place for lines that equal a variant, one with it for lines that differ in that place
                    keys += [v, mixed(v ^ mixed(places + np.uint64(1))), whole[line : line + 1]]
                    if not places_too:
                        continue
                    kinds += [np.zeros(len(v), np.int8), np.ones(len(v), np.int8), np.full(1, 2, np.int8)]
                m = 2 * (own.end - own.start)[some] + 1
                if not places_too:
                    yield pa.RecordBatch.from_pydict({"line": _signed(np.repeat(whole[some], m)), "key": _signed(np.concatenate(keys))})
                    continue
                of = pa.array(np.repeat([own.doc[x] for x in some], m))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column("_d").take(of), "tie": b.column("_t").take(of), "number": pa.array(np.repeat([own.number[x] for x in some], m), pa.int32()),
                    "line": _signed(np.repeat(whole[some], m)), "key": _signed(np.concatenate(keys)), "kind": pa.array(np.concatenate(kinds)),
                })

    # the same join as of near_lines, with whole rows, so that they are shuffled once
    again = rows.join(wanted, F.col("_d").eqNullSafe(F.col("w_id")) & (F.col("_t") == F.col("w_tie"))).select(*rows.columns, "numbers")
    variants = again.mapInArrow(emit, "doc_id bigint, tie int, number int, line bigint, key bigint, kind byte")
    # most keys are of one line alone; they are found by two integers each, and the others go on with their places
    keys_alone = again.mapInArrow(lambda batches: emit(batches, False), "line bigint, key bigint")
    met = keys_alone.groupBy("key").agg(F.min("line").alias("a"), F.max("line").alias("b")).where("a <> b").select("key")
    among = staged(variants.select("key", "kind", place.alias("p")).select("key", "kind", "p.*").join(met, "key").select("key", "kind", F.struct("id", "at").alias("first")))
    # kind 0: a variant, 1: a variant and its place, 2: a whole line
    least = among.groupBy("key").agg(F.min("first").alias("earliest"), F.min(F.when(F.col("kind") == 2, F.col("first"))).alias("whole"))
    witness = F.when(F.col("kind") == 0, F.col("whole")).otherwise(F.col("earliest"))
    near = among.join(least, "key").where(witness < F.col("first")).select("first", F.lit(True).alias("near")).distinct()
    fate = distinct.select("line", "first").join(near, "first", "left")
    gone = lines.withColumn("place", place).join(fate, "line").where(F.col("near").isNotNull() | (F.col("first") < F.col("place")))
    # a set: rows equal in id and text name the same lines
    return gone.groupBy("doc_id", "tie").agg(F.sort_array(F.collect_set("number")).alias("numbers"))


def _ranked_texts(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``_t``: 0 where an id has one row, else the rank of the text among the id's different texts.

    Texts of one id are told apart by 128 bits of hashes and their length, and ranked by the first 64. Only texts of ids that
    come more than once are looked at, and they are ranked by ranges, however many share an id.
    """
    several = staged(rows.groupBy("_d").agg(F.count("*").alias("rows")).where("rows > 1").select(F.col("_d").alias("_e")))
    if several.isEmpty():
        return rows.withColumn("_t", F.lit(0))
    value = F.coalesce(F.col(text), F.lit(""))
    marks = {"_h1": F.xxhash64(value), "_h2": F.xxhash64(F.lit(1), value), "_size": F.length(value)}
    marked = rows.select("_d", *[c.alias(name) for name, c in marks.items()])
    texts_of = marked.join(several, F.col("_d").eqNullSafe(F.col("_e")), "left_semi").distinct()
    ranked = numbered(texts_of, ["_d", *marks])
    first = ranked.groupBy("_d").agg(F.min("number").alias("first")).withColumnRenamed("_d", "_e")
    ranked = ranked.join(first, F.col("_d").eqNullSafe(F.col("_e"))).select(F.col("_d").alias("_e"), *[F.col(m).alias(f"r{m}") for m in marks], (F.col("number") - F.col("first")).cast("int").alias("_r"))
    same = F.col("_d").eqNullSafe(F.col("_e"))
    for m, c in marks.items():
        same = same & (c == F.col(f"r{m}"))
    return rows.join(ranked, same, "left").select(*rows.columns, F.coalesce("_r", F.lit(0)).alias("_t"))


def near_lines(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` with the lines that come again removed, and ``dropped_numbers``.

    Lines are parts between line feeds, numbered from 0; order is by doc_id, null ids last,
    then by a 64-bit hash of the text, then by number. Lines equal in their words are duplicates at
    any length, within a document too; lines without words stay. A removed line goes with its line feed.
    ``dropped_numbers`` is null where no line goes; then the text, which may be null or
    empty, is as it was. Rows equal in id and text are one document: each keeps or loses the
    same lines. Hashes of 64 bits stand for lines.
    """
    own = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    rows = _ranked_texts(docs.select(*[F.col(c).alias(own[c]) for c in docs.columns], F.col(doc_id).cast("bigint").alias("_d")), own[text])
    gone = dropped_lines(rows, own[text], min_words).select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), F.col("numbers").alias("_numbers"))
    joined = rows.join(gone, F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_tie")), "left")
    whole = F.col(own[text])

    def cut_out(lines):
        """Both lists are in order: what stays lies between neighbours of the list of what goes."""
        bounds = F.concat(F.array(F.lit(-1)), F.col("_numbers"), F.array(F.size(lines)))
        runs = let(bounds, lambda b: F.transform(F.sequence(F.lit(1), F.size(b) - 1), lambda i: F.slice(lines, F.get(b, i - 1) + 2, F.get(b, i) - F.get(b, i - 1) - 1)))
        return F.array_join(F.flatten(runs), "\n")

    out = joined.withColumn("_kept", F.when(F.col("_numbers").isNull(), whole).otherwise(let(F.split(whole, "\n", -1), cut_out)))
    columns = [F.col("_kept" if c == text else own[c]).alias(c) for c in docs.columns]
    return out.select(*columns, F.col("_numbers").alias("dropped_numbers"))
