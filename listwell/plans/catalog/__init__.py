"""Registered queries, each with the SQL that must give the same rows.

An entry is ``name: (build, sql)``. ``build(spark, sf_dir)`` returns a DataFrame; ``sql`` is
None where no SQL can say it.
"""

from __future__ import annotations

from listwell.plans.catalog import matching, pages, places, reports, streams, tables, texts

MODULES = (reports, tables, texts, matching, places, pages, streams)


def entries() -> dict:
    merged: dict = {}
    for module in MODULES:
        for name, entry in module.ENTRIES.items():
            if name in merged:
                raise ValueError(f"query {name} is registered twice")
            merged[name] = entry
    return merged
