"""Byte-level BPE as a finite-state transducer, and streaming decoding.

A sequence of tokens is the BPE encoding of its bytes if and only if every two neighbours
are the encoding of theirs: merges inside a token do not see what is around it, and the
first merge across a boundary would also happen in the pair alone. So a nondeterministic
machine can read a text byte by byte, guess where tokens end, and keep the guesses whose
neighbours agree; at the end one is left.

The machine is determinised lazily: a state is the set of open guesses, each with the tokens
it would emit, and a state's step on a byte is worked out when first needed. Tokens that all
guesses share are emitted. A guess lives no longer than its unfinished token finds bytes, so
the lookahead is bounded by the longest tokens.

Decoding runs tokens through an incremental UTF-8 machine. Its states are the bytes of an
unfinished character, and the step of a (state, token) is remembered.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwell.llm.common import Memo, pieces

MEMO_WORDS = 300_000
LONG_TEXT = 1 << 22
MEMO_STATES = 260_000
ROOT, NONE = 0, -1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a base64 token and a rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE by its definition: merge the neighbours of least rank, the leftmost first. For short inputs."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        joined = parts[best] + parts[best + 1]
        if joined not in ranks:
            break
        parts[best : best + 2] = [joined]
    return [ranks[p] for p in parts]


class State:
    """A set of guesses (trie node, last token, tokens to emit), its steps so far, and what it emits at the end."""

    __slots__ = ("end", "guesses", "steps")

    def __init__(self, guesses: tuple, end: tuple):
        self.guesses, self.end, self.steps = guesses, end, {}


class Transducer:
    """Encodes single matches; the tables grow as texts need them and start anew at MEMO_STATES."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.bytes_of = ranks, {r: t for t, r in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [NONE]
        for t, r in ranks.items():
            node = ROOT
            for b in t:
                there = self.children[node].get(b)
                if there is None:
                    there = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token.append(NONE)
                node = there
            self.token[node] = r
        self.fits: dict[int, bool] = {}  # by both ranks in one number
        self._clear()

    def _clear(self) -> None:
        self.states: dict[tuple, State] = {}
        self.start = self._state(((ROOT, NONE, ()),))

    def _state(self, guesses: tuple) -> State:
        found = self.states.get(guesses)
        if found is None:
            # a whole match that is a token is that token, whether or not merges lead to it
            whole = [(self.token[n],) for n, last, _ in guesses if last == NONE and self.token[n] != NONE]
            ends = whole or [out for n, last, out in guesses if n == ROOT and last != NONE]
            found = self.states[guesses] = State(guesses, ends[0] if ends else ())
        return found

    def _fit(self, a: int, b: int) -> bool:
        pair = a << 32 | b
        known = self.fits.get(pair)
        if known is None:
            if len(self.fits) > 2 * MEMO_STATES:
                self.fits.clear()
            known = self.fits[pair] = merged(self.bytes_of[a] + self.bytes_of[b], self.ranks) == [a, b]
        return known

    def _step(self, state: State, byte: int) -> tuple[State, tuple]:
        after = []
        for node, last, out in state.guesses:
            child = self.children[node].get(byte)
            if child is None:
                continue
            if self.children[child]:
                after.append((child, last, out))
            token = self.token[child]
            if token != NONE and (last == NONE or self._fit(last, token)):
                if not self.children[child] and last == NONE:
                    after.append((child, last, out))  # it may be the whole match
                after.append((ROOT, token, (*out, token)))
        shared = min((g[2] for g in after), key=len)
        for i, t in enumerate(shared):
            if any(g[2][i] != t for g in after):
                shared = shared[:i]
                break
        cut = len(shared)
        step = state.steps[byte] = (self._state(tuple(sorted((n, last, out[cut:]) for n, last, out in after))), shared)
        return step

    def encode(self, data: bytes) -> tuple[int, ...]:
        if len(self.states) > MEMO_STATES:
            self._clear()
        state, ids = self.start, []
        for i, byte in enumerate(data):
            step = state.steps.get(byte) or self._step(state, byte)
            state = step[0]
            if step[1]:
                ids += step[1]
            if i & 0xFFFF == 0xFFFF and len(self.states) > MEMO_STATES:  # a very long match: keep the place, forget the rest
                guesses = state.guesses
                self._clear()
                state = self._state(guesses)
        return (*ids, *state.end)


#: UTF-8 by lead byte: (from, to, bytes that follow, least and greatest of the first that follows).
LEADS = ((0x00, 0x7F, 0, 0, 0), (0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF), (0xED, 0xED, 2, 0x80, 0x9F), (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF), (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F))
LEAD = {b: (more, low, high) for first, last, more, low, high in LEADS for b in range(first, last + 1)}


def utf8_step(pending: bytes, data: bytes) -> tuple[str, bytes]:
    """Whole characters of pending + data, and the bytes of an unfinished one. Wrong bytes become U+FFFD."""
    text, held = [], pending
    for value in data:
        byte = bytes((value,))
        if held:
            more, low, high = LEAD[held[0]]
            if (low if len(held) == 1 else 0x80) <= value <= (high if len(held) == 1 else 0xBF):
                held += byte
                if len(held) == more + 1:
                    text.append(held.decode())
                    held = b""
                continue
            text.append("�")
            held = b""
        if value not in LEAD:
            text.append("�")
        elif LEAD[value][0]:
            held = byte
        else:
            text.append(chr(value))
    return "".join(text), held


class Decoder:
    """Decodes ids one at a time; a character split over tokens waits for its last byte."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.steps: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}

    def decode(self, ids) -> str:
        pending, out, table = b"", [], self.steps[b""]
        for i in ids:
            step = table.get(i)
            if step is None:
                step = table[i] = utf8_step(pending, self.bytes_of[i])
            out.append(step[0])
            if step[1] != pending:
                pending = step[1]
                table = self.steps.setdefault(pending, {})
        if pending:
            out.append("�")
        return "".join(out)


class Codec:
    """A pattern's matches encoded one by one; the ids of frequent matches are remembered."""

    def __init__(self, ranks_path: str, pattern: str, memo_words: int = MEMO_WORDS):
        ranks = read_ranks(ranks_path)
        self.pattern, self.machine, self.decoder = regex.compile(pattern), Transducer(ranks), Decoder(ranks)
        self.decimal = {r: str(r) for r in ranks.values()}
        self.memo = Memo(memo_words, lambda match: array("I", self.machine.encode(match.encode())).tobytes())

    def encode(self, text: str) -> array:
        # a list of matches is quicker to make; of a very long text it would be too long
        found = self.pattern.findall(text) if len(text) < LONG_TEXT else (m.group() for m in self.pattern.finditer(text))
        return array("I", b"".join(map(self.memo.__getitem__, found)))

    def decode(self, ids) -> str:
        return self.decoder.decode(ids)


_CODECS: dict[tuple[str, str, int], Codec] = {}


def codec(ranks_path: str, pattern: str, memo_words: int = MEMO_WORDS) -> Codec:
    """The codec of this Python worker: later tasks find the tables of earlier ones, of one codec at a time."""
    key = (ranks_path, pattern, memo_words)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(*key)
    return _CODECS[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): ids as little-endian 32-bit numbers, one row per row of ``docs``.

    A null or empty text has no ids. Ids of documents may be null or repeat. The ranks file
    is read where tasks run. Other columns are left out.
    """

    def run(batches):
        own = codec(ranks_path, pattern)
        for b in pieces(batches, "text"):
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "ids": pa.array([np.asarray(own.encode(t or ""), "<u4").tobytes() for t in b.column("text").to_pylist()], pa.binary())})

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, ids binary")


def decode_documents(tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids) as ``encode_documents`` gives them; null ids give an empty text."""

    def run(batches):
        own = codec(ranks_path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "text": pa.array([own.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in b.column("ids").to_pylist()], pa.string())})

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def token_digests(
    docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", memo_words: int = MEMO_WORDS
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded and its ids decoded again.

    ``memo_words`` matches, up to twice as many, are remembered by each worker: less takes less memory and more time. The digests are of the decimal ids joined by commas and of the decoded text in UTF-8.
    Nulls, empty texts and repeated rows as in ``encode_documents``.
    """

    def run(batches):
        own = codec(ranks_path, pattern, memo_words)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in pieces(batches, "text"):
            ids = [own.encode(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "n_tokens": pa.array(map(len, ids), pa.int64()),
                "ids_sha256": pa.array([sha(",".join(map(own.decimal.__getitem__, x)).encode()) for x in ids], pa.string()),
                "decoded_sha256": pa.array([sha(own.decode(x).encode()) for x in ids], pa.string()),
            })

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
