"""The page archive as a data source: pages as single objects under ``platform/date/market/merchant.html``.

    register(spark)
    spark.read.format("page_archive").load(path).where("platform = 'ubereats' AND date >= '2024-01-01'")

The driver lists folders, never files: a partition is one folder of a platform, day and market, and its task
lists and reads the files. Filters on the three columns choose the folders. As a stream it
gives the files that came since the last batch, by their time. Written to, it makes an object of each row.

The store is opened with ``pyarrow.fs``, which knows local, HDFS and S3 addresses; what only Spark
can open is read with :func:`listwell.sources.pages.read_pages`.
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
    LessThanOrEqual, WriterCommitMessage,
)

# Workers get these classes with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "page_key string, html string, platform string, date date, market string, merchant_id string"
FOLDERS = ("platform", "date", "market")
EXT = ".html"
BATCH_BYTES = 16_000_000
#: Seconds that a stream stays behind the clock, for files whose time lies a little back when they appear.
LAG = 10.0


@dataclass
class Folder(InputPartition):
    """A folder of the archive, and the times (in seconds) between which its files were written."""

    platform: str
    date: str
    market: str
    since: float = float("-inf")
    until: float = float("inf")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    store, base = fs.FileSystem.from_uri(path if ":" in path.split("/")[0] else f"file://{path}")
    return store, base.rstrip("/")


def _day(name: str) -> dt.date | None:
    try:
        return dt.date.fromisoformat(name)
    except ValueError:
        return None


class Choice:
    """What filters say about a folder's names; a filter that it does not know is left to Spark."""

    def __init__(self):
        self.tests: dict[str, list] = {c: [] for c in FOLDERS}

    def take(self, wanted) -> bool:
        column = wanted.attribute[0] if isinstance(wanted, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and len(wanted.attribute) == 1 else None
        if column not in self.tests:
            return False
        if isinstance(wanted, EqualTo):
            test = lambda v: v == wanted.value
        elif isinstance(wanted, In):
            test = lambda v: v in wanted.value
        elif column != "date":
            return False
        else:
            test = {
                GreaterThan: lambda v: v > wanted.value, GreaterThanOrEqual: lambda v: v >= wanted.value,
                LessThan: lambda v: v < wanted.value, LessThanOrEqual: lambda v: v <= wanted.value,
            }[type(wanted)]
        self.tests[column].append(test)
        return True

    def fits(self, column: str, name: str) -> bool:
        value = _day(name) if column == "date" else name
        return value is not None and all(test(value) for test in self.tests[column])


def folders(path: str, choice: Choice | None = None) -> list[tuple[str, str, str]]:
    """(platform, date, market) of the folders there are and that are wanted; others are not looked into."""
    store, base = _open(path)
    found: list[tuple[str, ...]] = [()]
    for column in FOLDERS:
        deeper = []
        for names in found:
            inside = store.get_file_info(fs.FileSelector("/".join((base, *names)), allow_not_found=True))
            deeper += [(*names, i.base_name) for i in inside if i.type == fs.FileType.Directory and (choice or Choice()).fits(column, i.base_name)]
        found = sorted(deeper)
    return found


def read_folder(path: str, part: Folder) -> Iterator[pa.RecordBatch]:
    store, base = _open(path)
    held, size = [], 0
    for info in sorted(store.get_file_info(fs.FileSelector(f"{base}/{part.platform}/{part.date}/{part.market}")), key=lambda i: i.base_name):
        if info.type != fs.FileType.File or not info.base_name.endswith(EXT) or not part.since < info.mtime_ns / 1e9 <= part.until:
            continue
        with store.open_input_stream(info.path) as body:
            html = body.read().decode("utf-8", "replace")
        key = f"{part.platform}/{part.date}/{part.market}/{info.base_name}"
        held.append((key, html, part.platform, _day(part.date), part.market, info.base_name.rsplit(".", 1)[0]))
        size += len(html)
        if size >= BATCH_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.date32(), pa.string(), pa.string())
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)


class PageReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.choice = path, Choice()

    def pushFilters(self, filters):
        yield from (f for f in filters if not self.choice.take(f))

    def partitions(self):
        return [Folder(*names) for names in folders(self.path, self.choice)] or [Folder("", "", "", 0.0, 0.0)]

    def read(self, partition):
        if partition.platform:
            yield from read_folder(self.path, partition)


class PageStreamReader(DataSourceStreamReader):
    """Files by the time they were written, up to ``lag`` seconds ago; a file that is written again comes again."""

    def __init__(self, path: str, lag: float):
        self.path, self.lag = path, lag

    def initialOffset(self):
        return {"until": 0.0}

    def latestOffset(self):
        return {"until": time.time() - self.lag}

    def partitions(self, start, end):
        found = [Folder(*names, since=start["until"], until=end["until"]) for names in folders(self.path)]
        return found or [Folder("", "", "", 0.0, 0.0)]

    def read(self, partition):
        if partition.platform:
            yield from read_folder(self.path, partition)

    def commit(self, end):
        pass


class PageWriter(DataSourceWriter):
    """An object for each row, under its key; a task that runs again writes the same objects again."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator):
        store, base = _open(self.path)
        made = set()
        for row in iterator:
            folder = f"{base}/{row['page_key'].rsplit('/', 1)[0]}"
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            with store.open_output_stream(f"{base}/{row['page_key']}") as out:
                out.write((row["html"] or "").encode())
        return WriterCommitMessage()


class PageArchive(DataSource):
    """``page_archive``: load or save a path in the archive's layout; ``lag`` is an option of the stream."""

    @classmethod
    def name(cls):
        return "page_archive"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PageReader(self.options["path"])

    def streamReader(self, schema):
        return PageStreamReader(self.options["path"], float(self.options.get("lag", LAG)))

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("the archive is only added to")
        return PageWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Makes the source known to the session, with the setting that lets it see filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageArchive)
