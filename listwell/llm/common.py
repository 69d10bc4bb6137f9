"""Helpers that several corpus operators share: words, hashes, bounded batches, tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listwell.session import ensure_checkpoint_dir

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
MEMO_WORDS = 200_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """The same rows, written as Parquet in the shared folder and read again: lineage ends there."""
    path = shared_folder(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(rows: DataFrame, order: list[Column | str], keep: list[Column | str] | None = None, name: str = "number") -> DataFrame:
    """The rows (``keep`` of their columns), staged, with their places 0, 1, … in the order given, nulls first when ascending.

    Ranges of the order go to partitions, which count their rows; only one offset per
    partition is broadcast. Columns of the order should tell most rows apart, as rows
    equal in all of them share a partition.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(dealt.select(*(keep or ["*"]), F.monotonically_increasing_id().alias("_place")))
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", (before - F.shiftleft("_part", 33)).alias("_offset"))
    return (
        placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_place") + F.col("_offset")).drop("_part", "_place", "_offset")
    )


def words(text: Column) -> Column:
    """The words of a text as an array; none for a null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, also where body uses it within other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


class Memo(dict):
    """Results of ``work`` for the keys used last: ``most`` to twice as many of at most 64 characters.

    A full memo becomes the old one, from which keys that are still in use come back.
    """

    def __init__(self, most: int, work):
        self.most, self.work, self.old = most, work, {}

    def keep(self, key, value) -> None:
        if len(key) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.work(key)
        self.keep(key, value)
        return value


class WordHash(dict):
    """64-bit hashes of words, remembered for at most MEMO_WORDS of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, so that lists of words stay small."""
    for batch in batches:
        column = batch.column(text)
        sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0))
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as bytes; null counts as empty."""
    return [b"" if x is None else x for x in batch.column(name).cast(pa.binary()).to_pylist()]
