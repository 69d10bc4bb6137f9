"""An n-gram trie in Elias-Fano form, and language-model scores of documents by it.

The trie has two levels, words and the words that follow them. A level is a file of flat
arrays that is mapped into memory: the contexts' numbers, pointers from each context to its
successors and the successors' numbers are monotone sequences in Elias-Fano code, and each
n-gram has a one-byte code of its quantised probability. A successor is stored relative to
its context, whose place is added to make the sequence of all successors monotone; a query
finds the context, and then the successor within the context's range.

The corpus is dealt into batches of documents, and the model into shards by n-gram. A batch
sends each shard the distinct n-grams that it has, with the counts of its training
documents; the shard adds up the counts, builds its part of the trie, and answers each batch
in the order of its questions. So n-grams are moved once, whichever documents are scored,
and both batches and shards have about PART_BYTES of text behind them at any size of the
corpus. An n-gram's shard depends on both words: one very common word is spread over many.

p(w | v) = (c(v w) + mass p(w)) / (c(v) + mass), p(w) = (c(w) + 1/2) / (N + (V + 1) / 2): a
Dirichlet prior (MacKay and Peto, 1995) that sums to one over the words and one unknown.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwell.llm.common import WordHash, mixed

PART_BYTES = 12_000_000
MASS = 30.0
KEY_BITS = 40
KEY = np.uint64((1 << KEY_BITS) - 1)
SPREAD = 64
START = np.uint64(xxhash.xxh3_64_intdigest(b"\x00start"))
END = np.uint64(xxhash.xxh3_64_intdigest(b"\x00end"))


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits one after another, in 64-bit words."""
    out = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if width and len(values):
        bit = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        np.bitwise_or.at(out, word, values << shift)
        over = shift + np.uint64(width) > 64
        np.bitwise_or.at(out, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return out


def _unpacked(words: np.ndarray, width: int, i: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(i), np.uint64)
    bit = i.astype(np.uint64) * np.uint64(width)
    word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return (low | high) & np.uint64((1 << width) - 1)


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary. Opening it finds the places of the high bits."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        bits = np.unpackbits(high, bitorder="little")
        self.ones = np.flatnonzero(bits)[:n].astype(np.int64)
        self.zeros = np.flatnonzero(bits == 0).astype(np.int64)

    @staticmethod
    def code(values: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
        n, top = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        upper = (values >> np.uint64(width)).astype(np.int64)
        high = np.zeros(n + (int(upper[-1]) if n else 0) + 2, np.uint8)
        high[upper + np.arange(n)] = 1
        return n, width, _packed(values & np.uint64((1 << width) - 1), width), np.packbits(high, bitorder="little")

    def at(self, i: np.ndarray) -> np.ndarray:
        return ((self.ones[i] - i).astype(np.uint64) << np.uint64(self.width)) | _unpacked(self.low, self.width, i)

    def search(self, values: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> np.ndarray:
        """Place of the first element that is not less, between lo and hi where given.

        The high bits of a value name a bucket; its elements are between two zeros.
        """
        upper = np.minimum(values >> np.uint64(self.width), np.uint64(len(self.zeros) - 1)).astype(np.int64)
        first = np.where(upper > 0, self.zeros[np.maximum(upper - 1, 0)] - upper + 1, 0)
        last = self.zeros[upper] - upper
        first, last = np.minimum(first, self.n), np.minimum(last, self.n)
        if lo is not None:
            first, last = np.clip(first, lo, hi), np.clip(last, lo, hi)
        open_ = np.flatnonzero(first < last)
        while len(open_):
            mid = (first[open_] + last[open_]) // 2
            less = self.at(mid) < values[open_]
            first[open_[less]], last[open_[~less]] = mid[less] + 1, mid[~less]
            open_ = open_[first[open_] < last[open_]]
        return first


EXACT = 128  # counts below are their own code


def quantised(counts: np.ndarray, top: int) -> np.ndarray:
    """One-byte codes: counts below EXACT as they are, greater ones on a logarithmic scale that ends at ``top``, the greatest there is."""
    spread = np.log2(max(top, EXACT + 1) / EXACT)
    large = EXACT + np.round(127 * np.log2(np.maximum(counts, EXACT) / EXACT) / spread).astype(np.int64)
    return np.where(counts < EXACT, counts, large).astype(np.uint8)


def levels(top: int) -> np.ndarray:
    """The count that each code stands for; divided by the number of training tokens it is a joint probability."""
    return np.concatenate([np.arange(float(EXACT)), EXACT * (max(top, EXACT + 1) / EXACT) ** (np.arange(128) / 127)])


class Trie:
    """Levels mapped from one file. Build with ``write``; contexts and successors are KEY_BITS hashes."""

    PARTS = ("contexts", "pointers", "successors")

    @staticmethod
    def write(path: str, context: np.ndarray, successor: np.ndarray, counts: np.ndarray) -> None:
        """From distinct n-grams sorted by context and successor, with counts over 0."""
        own, first = np.unique(context, return_index=True)
        of = np.repeat(np.arange(len(own), dtype=np.uint64), np.diff(np.append(first, len(context))))
        top = int(counts.max(initial=0))
        sequences = (own, np.append(first, len(context)).astype(np.uint64), (of << np.uint64(KEY_BITS)) | successor)
        head, body = [], []
        for values in sequences:
            n, width, low, high = EliasFano.code(values)
            head += [n, width, len(low), len(high)]
            body += [low.tobytes(), high.tobytes() + bytes(-len(high) % 8)]
        with open(path, "wb") as out:
            out.write(np.array([*head, top], np.int64).tobytes())
            out.write(b"".join(body))
            out.write(quantised(counts, top).tobytes())

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        head, at = data[: 13 * 8].view(np.int64).tolist(), 13 * 8
        self.top = head[12]
        for i, name in enumerate(self.PARTS):
            n, width, n_low, n_high = head[4 * i : 4 * i + 4]
            low = data[at : at + 8 * n_low].view(np.uint64)
            at += 8 * n_low
            setattr(self, name, EliasFano(n, width, low, data[at : at + n_high]))
            at += n_high + -n_high % 8
        self.codes = data[at : at + self.successors.n]

    def look_up(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """The codes of n-grams; 0 for those not in the trie."""
        out = np.zeros(len(context), np.uint8)
        if not self.contexts.n:
            return out
        place = self.contexts.search(context)
        there = np.flatnonzero(place < self.contexts.n)
        there = there[self.contexts.at(place[there]) == context[there]]
        at = place[there]
        lo, hi = self.pointers.at(at).astype(np.int64), self.pointers.at(at + 1).astype(np.int64)
        wanted = (at.astype(np.uint64) << np.uint64(KEY_BITS)) | successor[there]
        found = self.successors.search(wanted, lo, hi)
        sure = np.flatnonzero(found < hi)
        sure = sure[self.successors.at(found[sure]) == wanted[sure]]
        out[there[sure]] = self.codes[found[sure]]
        return out


class Batch:
    """The tokens of a batch of documents, its distinct words, and its distinct pairs of neighbours."""

    def __init__(self, found: list[str | None]):
        hashes, own, sizes = WordHash(), [], []
        for text in found:
            w = hashes.of((text or "").encode().lower().split())
            own += [w, np.array([END])]
            sizes.append(len(w) + 1)
        self.sizes = np.array(sizes, np.int64)
        tokens = np.concatenate(own) if own else np.zeros(0, np.uint64)
        self.words, self.word = np.unique(np.append(tokens, START), return_inverse=True)
        start, self.word = self.word[-1], self.word[:-1]
        self.starts = np.cumsum(self.sizes) - self.sizes
        before = np.roll(self.word, 1)
        before[self.starts] = start
        self.before = before
        pairs, self.pair = np.unique((before.astype(np.uint64) << np.uint64(32)) | self.word.astype(np.uint64), return_inverse=True)
        context, successor = self.words[(pairs >> np.uint64(32)).astype(np.int64)] & KEY, self.words[(pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)] & KEY
        self.context, self.successor = context, successor

    def shards(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Each word's and each pair's shard."""
        spread = mixed(self.context * np.uint64(SPREAD) + self.successor % np.uint64(SPREAD))
        return (mixed(self.words) % np.uint64(n)).astype(np.int64), (spread % np.uint64(n)).astype(np.int64)


def _by_shard(shard: np.ndarray, n: int) -> list[np.ndarray]:
    """Places of each shard's entries, in order."""
    order = np.argsort(shard, kind="stable")
    return np.split(order, np.searchsorted(shard[order], np.arange(1, n)))


def _short(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].tobytes()


def _long(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) * 8 // KEY_BITS, 8), np.uint8)
    out[:, : KEY_BITS // 8] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BITS // 8)
    return out.view("<u8").reshape(-1)


def _binaries(**columns) -> dict[str, pa.Array]:
    return {k: pa.array(v, pa.binary()) for k, v in columns.items()}


def _ask(table: pa.Table, n: int) -> pa.Table:
    """What a batch asks of each shard, with its training counts."""
    own = Batch(table.column("text").to_pylist())
    train = np.repeat(~table.column("held_out").to_numpy(), own.sizes)
    word_counts = np.bincount(own.word[train], minlength=len(own.words)).astype("<u4")
    pair_counts = np.bincount(own.pair[train], minlength=len(own.context)).astype("<u4")
    of_word, of_pair = own.shards(n)
    words, pairs = _by_shard(of_word, n), _by_shard(of_pair, n)
    batch = table.column("batch")[0].as_py()
    return pa.table({"batch": pa.array([batch] * n, pa.int32()), "shard": pa.array(range(n), pa.int32())} | _binaries(
        words=[own.words[i].astype("<u8").tobytes() for i in words], word_counts=[word_counts[i].tobytes() for i in words],
        contexts=[_short(own.context[i]) for i in pairs], successors=[_short(own.successor[i]) for i in pairs], pair_counts=[pair_counts[i].tobytes() for i in pairs],
    ))


def _answer(table: pa.Table) -> pa.Table:
    """A shard's counts added up, its trie built, and every batch answered from it."""
    of = lambda name: table.column(name).to_pylist()
    words, counts = [np.frombuffer(x, "<u8") for x in of("words")], np.frombuffer(b"".join(of("word_counts")), "<u4")
    distinct, place = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)
    ends = np.cumsum([len(w) for w in words])[:-1]
    word_answers = np.split(total[place].astype("<u8"), ends)

    contexts, successors = [_long(x) for x in of("contexts")], [_long(x) for x in of("successors")]
    sizes, c, s = np.cumsum([len(x) for x in contexts])[:-1], np.concatenate(contexts), np.concatenate(successors)
    order = np.lexsort((s, c))
    new = np.ones(len(c), bool)
    new[1:] = (c[order][1:] != c[order][:-1]) | (s[order][1:] != s[order][:-1])
    number = np.cumsum(new) - 1
    c, s = c[order][new], s[order][new]
    sums = np.bincount(number, weights=np.frombuffer(b"".join(of("pair_counts")), "<u4")[order], minlength=len(c)).astype(np.int64)
    seen = sums > 0
    handle, path = tempfile.mkstemp(suffix=".trie")
    os.close(handle)
    try:
        Trie.write(path, c[seen], s[seen], sums[seen])
        trie = Trie(path)
        codes, top = trie.look_up(c, s), trie.top
    finally:
        os.unlink(path)
    pair_codes = np.empty(len(order), np.uint8)
    pair_codes[order] = codes[number]
    m = len(words)
    return pa.table({
        "batch": table.column("batch"), "shard": table.column("shard"), "tokens": pa.array([int(total.sum())] * m, pa.int64()), "types": pa.array([int((total > 0).sum())] * m, pa.int64()), "top": pa.array([top] * m, pa.int64()),
    } | _binaries(word_counts=[x.tobytes() for x in word_answers[:m]], pair_codes=[x.tobytes() for x in np.split(pair_codes, sizes)]))


def _scores(docs: pa.Table, answers: pa.Table, n: int, mass: float) -> pa.Table:
    tokens, types = (sum(answers.column(c).to_pylist()) for c in ("tokens", "types"))  # every shard has answered every batch
    own = Batch(docs.column("text").to_pylist())
    words, pairs = (_by_shard(x, n) for x in own.shards(n))
    counts, pair_counts = np.zeros(len(own.words)), np.zeros(len(own.context))
    for shard, top, w, p in zip(*[answers.column(c).to_pylist() for c in ("shard", "top", "word_counts", "pair_codes")]):
        counts[words[shard]] = np.frombuffer(w, "<u8")
        pair_counts[pairs[shard]] = levels(top)[np.frombuffer(p, np.uint8)]
    unigram = (counts + 0.5) / (tokens + 0.5 * (types + 1))
    ends = counts[np.searchsorted(own.words, END)]  # as many as texts that start
    context = np.where(own.words == START, ends, counts)[own.before]
    p = (pair_counts[own.pair] + mass * unigram[own.word]) / (context + mass)
    total = lambda x: np.add.reduceat(x, own.starts)
    return pa.table({
        "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(own.sizes), "n_known": pa.array(total((counts[own.word] > 0).astype(np.int64))),
        "train_tokens": pa.array(np.full(len(own.sizes), tokens, np.int64)), "base_score": pa.array(total(np.log10(unigram)[own.word])), "score": pa.array(total(np.log10(p))),
    })


def score_documents(docs: DataFrame, held_out: str | None = None, mass: float = MASS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    ``held_out`` names a boolean column of documents to score but not to learn from (null:
    to learn from); by default those whose crc32(doc_id as text) mod 5 is 1. Tokens are the
    words, with A-Z in lower case, and an end. ``base_score`` sums log10 of p(w), ``score``
    of p(w | v). A null or empty text is an end alone. Ids may be null or repeat: rows are
    scored each by itself, and copies count as often as they are there. With no training
    documents all counts are 0 and p(w) is 1. Other columns are left out. Hashes of 64 bits stand for
    words, of 40 bits for words within a pair; counts of words are exact, those of pairs
    from 128 on are rounded on a logarithmic scale of 128 steps up to the greatest of their shard, however
    great it is: by an eightieth where that is a thousand, a thirtieth where it is ten million.
    """
    mark = F.col(held_out) if held_out else F.crc32(F.col(doc_id).cast("string")) % 5 == 1
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(mark, F.lit(False)).alias("held_out"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0]
    if size is None:
        size = 0
    n = max(1, -(-size // PART_BYTES))
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int"))
    # one plan, so that the dealt documents are shuffled once for asking and scoring
    asked = dealt.groupBy("batch").applyInArrow(lambda t: _ask(t, n), "batch int, shard int, words binary, word_counts binary, contexts binary, successors binary, pair_counts binary")
    answered = asked.groupBy("shard").applyInArrow(_answer, "batch int, shard int, tokens bigint, types bigint, top bigint, word_counts binary, pair_codes binary")
    return dealt.groupBy("batch").cogroup(answered.groupBy("batch")).applyInArrow(lambda d, a: _scores(d, a, n, mass), schema)
