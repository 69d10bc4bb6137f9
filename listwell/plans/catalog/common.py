"""Helpers for registering queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwell.plans import bind


def portable(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: dates and times as text, decimals as doubles, lists joined."""
    cols = []
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f.name)
        if kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind == "decimal":
            c = c.cast("double")
        elif kind == "array":
            c = F.when(c.isNotNull(), F.array_join(F.transform(c, lambda x: x.cast("string")), "|"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def on(*names: str) -> Callable:
    """Decorator: the function gets the named tables and its result is made portable."""

    def wrap(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(*[bind.table(spark, sf_dir, n) for n in names]))

        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        return build

    return wrap


def oracle(body: str, *names: str) -> str:
    """SQL with the named derived tables in front."""
    derived = [n for n in names if n in bind.TABLES]
    clauses = bind.ctes(*derived)
    text = body.strip()
    if not clauses:
        return text
    if text.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {clauses},\n{text[15:]}"
    if text.upper().startswith("WITH "):
        return f"WITH {clauses},\n{text[5:]}"
    return f"WITH {clauses}\n{text}"


def doubles(sql: str, *columns: str) -> str:
    """The same rows with the named columns as doubles rather than decimals."""
    return f"SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in columns)}) FROM ({sql})"


def registrar():
    """(entries, register): ``register(name, tables, sql)`` decorates a function of those tables."""
    found: dict = {}

    def register(name: str, names: tuple[str, ...], sql: str | None):
        def wrap(fn):
            found[name] = (on(*names)(fn), None if sql is None else oracle(sql, *names))
            return fn

        return wrap

    return found, register
