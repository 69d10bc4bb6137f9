"""Token ids of documents in bit planes: encoding, writing, reading back.

Ids are cut into blocks of BLOCK. A block is transposed into bit planes (the i-th bits of
all its ids together) and each plane is compressed with zstandard; the upper planes of
small ids are all zero and cost a few bytes. A chunk is one or more blocks that hold whole
documents; the chunk index says where in the sequence of all ids each chunk starts and how
long its documents are. Spark writes chunks and index as Parquet, so that any file system
it knows will do, a lost task is simply run again and a reader can take any chunk alone.

Documents are in ascending doc_id order over all chunks: ranges of ids go to tasks, and the
starts are prefix sums over tasks and over the chunks of a task.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listwell.llm.common import pieces

BLOCK = 16_384
CHUNK = 65_536
MEMO_WORDS = 500_000
MEMO_PIECES = 200_000
TEXT_BYTES = 8_000_000  # texts whose words are looked up together

CHUNK_SCHEMA = "part int, chunk int, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, planes array<binary>"


def to_planes(ids: np.ndarray) -> list[bytes]:
    """Compressed bit planes of the ids, block by block; the last block is filled up with zeros."""
    pack, out = zstandard.ZstdCompressor(level=3), []
    padded = np.zeros(-(-len(ids) // BLOCK) * BLOCK, "<u4")
    padded[: len(ids)] = ids
    for block in padded.reshape(-1, BLOCK):
        bits = np.unpackbits(block.view(np.uint8).reshape(BLOCK, 4), axis=1, bitorder="little")
        width = int(block.max()).bit_length()
        planes = np.packbits(np.ascontiguousarray(bits[:, :width].T), axis=1, bitorder="little")
        out.append(bytes([width]))
        out += [pack.compress(p.tobytes()) for p in planes]
    return out


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids that ``to_planes`` was given."""
    unpack, found, at = zstandard.ZstdDecompressor(), [], 0
    while at < len(planes):
        width = planes[at][0]
        bits = np.zeros((32, BLOCK), np.uint8)
        for i, plane in enumerate(planes[at + 1 : at + 1 + width]):
            bits[i] = np.unpackbits(np.frombuffer(unpack.decompress(plane), np.uint8), bitorder="little")
        found.append(np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").reshape(-1).view("<u4"))
        at += 1 + width
    return np.concatenate(found)[:n] if found else np.zeros(0, "<u4")


_ENCODERS: dict[str, Encoder] = {}

BINARY = pa.large_binary()


def _plain_pieces(spec: dict):
    """A compiled pattern that cuts lower-cased words of printable ASCII, a line feed between them, as the vocabulary does, or None.

    It is known for vocabularies that normalise and lower-case, cut by one pattern, and end a piece
    with a suffix: printable ASCII bytes stand for themselves there. The line feeds are matched too.
    """
    rules = [r["type"] for part, many in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")) for r in (spec[part] or {}).get(many, [])]
    if rules != ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]:
        return None
    split, level = spec["pre_tokenizer"]["pretokenizers"]
    if (split["behavior"], split["invert"], level["add_prefix_space"], level["use_regex"]) != ("Removed", True, False, False):
        return None
    return regex.compile(f"{split['pattern']['Regex']}|\n")


def _binary(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The ids from each bound to the next as an array of little-endian 32-bit numbers."""
    return pa.LargeBinaryArray.from_buffers(BINARY, len(bounds) - 1, [None, pa.py_buffer(4 * np.asarray(bounds, np.int64)), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])


def _ends(found: pa.Array) -> np.ndarray:
    """Where the values of an array of ids start in its data, in ids, and the last one ends."""
    return np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(found) + 1] // 4


def _joined(words: pa.Array, most: int, between: str) -> list[tuple[int, str]]:
    """(number, text) of each run of ``most`` words, joined."""
    cuts = np.append(np.arange(0, len(words), most), len(words))
    runs = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words.cast(pa.string())), between)
    return list(zip(np.diff(cuts).tolist(), runs.to_pylist()))


class Known:
    """Ids of the keys used last, ``most`` of at most 64 bytes; many keys are looked up at once, ``work`` has ids for new ones."""

    def __init__(self, most: int, work: Callable[[pa.Array], pa.Array]):
        self.most, self.work = most, work
        self.keys = self.ids = pa.array([], BINARY)

    def of(self, keys: pa.Array) -> pa.Array:
        """The ids of distinct keys."""
        at = pc.index_in(keys, value_set=self.keys).fill_null(-1).to_numpy().astype(np.int64)
        new = at < 0
        used = np.zeros(len(self.keys), bool)
        used[at[~new]] = True
        at[new] = len(self.keys) + np.arange(new.sum())
        ids = pa.concat_arrays([self.ids, self.work(keys.filter(pa.array(new)))]).take(pa.array(at))
        short = np.flatnonzero(np.asarray(pc.binary_length(keys)) <= 64)[-self.most :]
        rest = pa.array(np.flatnonzero(~used)[len(short) - self.most :] if len(short) < self.most else np.zeros(0, np.int64))
        short = pa.array(short)
        self.keys, self.ids = (pa.concat_arrays([old.take(rest), own.take(short)]) for old, own in ((self.keys, keys), (self.ids, ids)))
        return ids


class Encoder:
    """Ids of words, by the tokenizers library.

    The vocabulary's rules never look across ASCII white space, which it drops; a text's ids are those
    of its words one after another. Each distinct word of a batch is looked up once, and the ids of words
    used last are remembered. The new words of a batch go to the library together. Those of printable
    ASCII are cut into pieces here, and pieces not met before go, a space between them, to the
    vocabulary's model alone. Words of other characters go to the whole vocabulary with a digit between
    them, which is always a token of its own. Later tasks of a Python worker find the words of earlier ones.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task on each core already
        self.whole = Tokenizer.from_file(vocabulary)
        self.whole.encode_special_tokens = True
        spec = json.loads(self.whole.to_str())
        self.pattern = _plain_pieces(spec)
        self.model = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}))
        self.between = self.whole.encode("0", add_special_tokens=False).ids[0]
        self.words, self.pieces = Known(MEMO_WORDS, self._of_new), Known(MEMO_PIECES, self._of_pieces)

    def _of_pieces(self, pieces: pa.Array) -> pa.Array:
        ids, lengths = [], []
        for n, text in _joined(pieces, 1000, " "):
            got = self.model.encode(text, add_special_tokens=False)
            ids.append(got.ids)
            lengths.append(np.bincount(np.array(got.word_ids, np.int64), minlength=n))
        return _binary(np.concatenate([[], *ids]).astype("<u4"), np.cumsum(np.concatenate([[0], *lengths])))

    def _of_plain(self, text: str) -> pa.Array:
        """The ids of words with a line feed between them."""
        found = pa.array(self.pattern.findall(text.lower()), pa.large_string()).dictionary_encode()
        border, at = np.asarray(pc.equal(found.dictionary, "\n")), np.asarray(found.indices)
        pieces = found.dictionary.filter(pa.array(~border)).cast(BINARY)
        place = np.where(border, len(pieces), np.cumsum(~border) - 1)  # line feeds have no ids
        ids = pa.concat_arrays([self.pieces.of(pieces), pa.array([b""], BINARY)]).take(pa.array(place[at]))
        return _binary(np.frombuffer(ids.buffers()[2] or b"", "<u4"), _ends(ids)[np.concatenate([[0], np.flatnonzero(border[at]), [len(at)]])])

    def _of_others(self, n: int, text: str) -> pa.Array:
        """The ids of ``n`` words with a digit between them."""
        ids = np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        borders = np.flatnonzero(ids == self.between)
        if len(borders) != n - 1:
            return self._of_each(text.split(" 0 "))
        return _binary(np.delete(ids, borders), np.concatenate([[0], borders - np.arange(len(borders)), [len(ids) - len(borders)]]))

    def _of_each(self, words: list[str]) -> pa.Array:
        return pa.array([np.array(self.whole.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words], BINARY)

    def _of_new(self, words: pa.Array) -> pa.Array:
        text = words.cast(pa.large_string())
        plain = np.asarray(pc.match_substring_regex(text, "^[!-~]+$")) & bool(self.pattern)
        others = ~plain & ~np.asarray(pc.match_substring(text, "0")) & bool(self.pattern)
        some = [words.filter(pa.array(which)) for which in (plain, others, ~plain & ~others)]
        made = [
            pa.array([], BINARY), *(self._of_plain(t) for _, t in _joined(some[0], 100_000, "\n")), *(self._of_others(n, t) for n, t in _joined(some[1], 200, " 0 ")),
            self._of_each(some[2].cast(pa.large_string()).to_pylist()),
        ]
        return pa.concat_arrays(made).take(pa.array(np.argsort(np.where(plain, 0, np.where(others, 1, 2)), kind="stable").argsort()))

    def _of_all(self, found: pa.Array) -> pa.Array:
        coded = found.dictionary_encode()
        return self.words.of(coded.dictionary).take(coded.indices)

    def of_texts(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a column; nulls count as empty."""
        split = pc.ascii_split_whitespace(column.cast(pa.large_string()).fill_null(""))
        ids = self._of_all(split.flatten().cast(BINARY))
        bounds = np.asarray(split.offsets)
        bounds, flat = _ends(ids)[bounds - bounds[0]].tolist(), np.frombuffer(ids.buffers()[2] or b"", "<u4")
        return [flat[a:b] for a, b in zip(bounds, bounds[1:])]

    def __call__(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(self._of_all(pa.array(words, BINARY)).to_pylist()), "<u4")


def encoder(vocabulary: str) -> Encoder:
    """The encoder of this Python worker: a function from the words of a text to its ids."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write ``path``/chunks and ``path``/index for all documents in ascending doc_id order.

    ``vocabulary`` is a tokenizers file that every executor has. Null texts are empty and
    hold the end id alone; the names of special tokens are ordinary text; null ids come first; rows that share an id follow in the order of
    their text, and are written each. Other columns are left out.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ranged = rows.withColumn("tie", tie).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def encoded(batches):
        from pyspark import TaskContext

        part, chunk, encode = TaskContext.get().partitionId(), 0, encoder(vocabulary)
        ids, names, lengths, held = [], [], [], 0

        def row():
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "chunk": pa.array([chunk], pa.int32()), "n_ids": [held], "doc_ids": pa.array([names], pa.list_(pa.int64())),
                "lengths": pa.array([lengths], pa.list_(pa.int64())), "planes": pa.array([to_planes(np.concatenate(ids))], pa.list_(pa.binary())),
            })

        for b in pieces(batches, "text", TEXT_BYTES):
            for name, found in zip(b.column("doc_id").to_pylist(), encode.of_texts(b.column("text"))):
                own = np.append(found, np.uint32(end_id)).astype("<u4")
                ids.append(own)
                names.append(name)
                lengths.append(len(own))
                held += len(own)
                if held >= CHUNK:
                    yield row()
                    ids, names, lengths, held, chunk = [], [], [], 0, chunk + 1
        if names:
            yield row()

    ranged.select("doc_id", "text").mapInArrow(encoded, CHUNK_SCHEMA).write.mode("overwrite").option("compression", "none").parquet(f"{path}/chunks")
    chunks = spark.read.parquet(f"{path}/chunks").select("part", "chunk", "n_ids", F.size("doc_ids").alias("n_docs"))
    before = (Window.unboundedPreceding, -1)
    so_far = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(*before)), F.lit(0))
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", so_far(Window.orderBy("part")).alias("base"))
    index = chunks.withColumn("off", so_far(Window.partitionBy("part").orderBy("chunk"))).join(parts, "part")
    index.select("part", "chunk", (F.col("base") + F.col("off")).alias("start"), "n_ids", "n_docs").write.mode("overwrite").parquet(f"{path}/index")


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, part, chunk, off, ids) of written files; off counts from the start of the chunk."""

    def decoded(batches):
        for b in batches:
            for r in range(b.num_rows):
                at = {c: b.column(c)[r].as_py() for c in b.schema.names}
                ids, n = from_planes(at["planes"], at["n_ids"]), len(at["lengths"])
                offsets = np.concatenate([[0], np.cumsum(at["lengths"], dtype=np.int64)])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(at["doc_ids"], pa.int64()), "part": pa.array([at["part"]] * n, pa.int32()), "chunk": pa.array([at["chunk"]] * n, pa.int32()),
                    "off": offsets[:-1], "ids": [ids[x:y].tobytes() for x, y in zip(offsets, offsets[1:])],
                })

    return spark.read.parquet(f"{path}/chunks").mapInArrow(decoded, "doc_id bigint, part int, chunk int, off bigint, ids binary")


def _started(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    index = spark.read.parquet(f"{path}/index").select("part", "chunk", F.col("start").alias("base"))
    return rows.join(index, ["part", "chunk"]).withColumn("start", F.col("base") + F.col("off")).drop("part", "chunk", "base", "off")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids, start): the documents of written files; start counts the ids before each, ids are little-endian 32-bit numbers."""
    return _started(spark, path, _documents(spark, path))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents of written files, all of which are decoded."""
    short = _documents(spark, path).select("doc_id", "part", "chunk", "off", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    return _started(spark, path, short).select("doc_id", "start", "n_tokens", "ids_crc32")
