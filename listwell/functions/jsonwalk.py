"""Search at any depth in JSON text, inside Arrow UDFs.

Paths of fixed depth are read with Spark's variant functions. Only "wherever it is" needs
this walk, and it returns JSON text, so the fields are read in Spark again.
"""

from __future__ import annotations

import json
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXTS = T.ArrayType(T.StringType())
ID_KEYS = ("uuid", "storeUUID", "id", "slug", "storeSlug", "platform_id")  # fixed value
ABSENT = object()


def load(text: str):
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        return ABSENT


def dump(value) -> str | None:
    return None if value is ABSENT else json.dumps(value, ensure_ascii=False)


def walk(root, nested: bool = False, into=lambda node: True):
    """Objects in depth-first order; ``nested`` also opens JSON kept in strings."""
    stack = [root]
    while stack:
        node = stack.pop()
        if nested and isinstance(node, str) and node[:1] in ("{", "["):
            inner = load(node)
            node = inner if inner is not ABSENT else node
        if isinstance(node, dict):
            yield node
            if into(node):
                stack.extend(reversed(list(node.values())))
        elif isinstance(node, list):
            stack.extend(reversed(node))


def value_of_key(text: str, key: str) -> str | None:
    """First non-null value stored under ``key``."""
    hits = (n[key] for n in walk(load(text)) if n.get(key) is not None)
    return dump(next(hits, ABSENT))


def object_with_id(root, wanted: str):
    """First non-empty object one of whose id keys has the value, compared as text."""
    for node in walk(root, nested=True):
        if any(str(node.get(k)) == wanted for k in ID_KEYS):
            return node
    return ABSENT


def objects_with_ids(root, wanted) -> dict:
    """For each id the object that :func:`object_with_id` finds, in one walk for all of them."""
    found: dict = {}
    left = set(wanted)
    for node in walk(root, nested=True):
        if not left:
            break
        for known in {str(node.get(k)) for k in ID_KEYS} & left:
            found[known] = node
            left.discard(known)
    return found


def first_places(text: str, ids) -> dict[str, int]:
    """Where each id first stands in the text; one pass whatever their number."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for i in ids:
        machine.add_word(i, i)
    machine.make_automaton()
    found: dict[str, int] = {}
    for end, i in machine.iter(text):
        found.setdefault(i, end - len(i) + 1)
    return found


def addressed_object(text: str) -> str | None:
    """First object with a street address or an address object."""
    hits = (n for n in walk(load(text)) if "streetAddress" in n or isinstance(n.get("address"), dict))
    return dump(next(hits, ABSENT))


def is_place(node: dict) -> bool:
    at = node.get("location")
    return "name" in node and isinstance(at, dict) and ("lat" in at or "latitude" in at)


def places(root) -> list[str]:
    """All objects with a name and a located place, outermost ones only."""
    return [dump(n) for n in walk(root, into=lambda n: not is_place(n)) if is_place(n)]


def restaurants(*payloads: str | None) -> dict | None:
    """In the first payload that has either: the ``restaurantData`` map, else loose places."""
    for text in payloads:
        root = load(text) if text else ABSENT
        known = next((n["restaurantData"] for n in walk(root) if n.get("restaurantData") is not None), None)
        if isinstance(known, dict) and any(isinstance(v, dict) for v in known.values()):
            return {"known": dump(known), "places": None}
        loose = places(root)
        if loose:
            return {"known": None, "places": loose}
    return None


def _per_text(read, returns: T.DataType):
    @F.pandas_udf(returns)
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([read(t) if t else None for t in text], dtype="object")

    return run


def find_key(text, key: str):
    """Column: JSON text of the first value under ``key`` at any depth."""
    return _per_text(lambda t: value_of_key(t, key), T.StringType())(F.when(text.contains(f'"{key}"'), text))


@F.pandas_udf(T.StringType())
def find_object(text: pd.Series, wanted: pd.Series) -> pd.Series:
    """JSON text of the object with the id; rows of one page follow each other, so a text is parsed once."""
    out, last, root = [], None, ABSENT
    for t, w in zip(text, wanted):
        if t is None or w is None:
            out.append(None)
            continue
        if t != last:
            last, root = t, load(t)
        out.append(dump(object_with_id(root, w)))
    return pd.Series(out, dtype="object")


def unescaped(state: str) -> str:
    """Page state without its escapes, as ``text.unescape_state`` gives it."""
    plain = state.replace("\\u0022", '"').replace('\\"', '"')
    return plain[1:-1] if len(plain) > 1 and plain[0] == plain[-1] == '"' else plain


SPOT = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType())])
TOLD = T.ArrayType(T.StructType([T.StructField("n0", SPOT), T.StructField("n1", SPOT), T.StructField("o0", T.StringType()), T.StructField("o1", T.StringType())]))


def stores_in_state(ids, state: str | None, reach: int, lat, lng) -> list[tuple]:
    """(coordinates near the id, JSON text of its object) of each id in one page state.

    All ids are searched for in one pass. The state is opened once, for those that it names without
    coordinates (both, neither of them 0) within ``reach`` letters on either side.
    """
    at = first_places(state, ids) if state and len(ids) else {}
    near = {}
    for i, place in at.items():
        window = state[max(0, place - reach) : place + reach]
        found = [p.search(window) for p in (lat, lng)]
        spot = tuple(float(m[1]) for m in found) if all(found) else (0.0, 0.0)
        if all(spot):
            near[i] = dict(zip(("lat", "lng"), spot))
    silent = [i for i in at if i not in near]
    objects = objects_with_ids(load(unescaped(state)), silent) if silent else {}
    return [(near.get(i), dump(objects.get(i, ABSENT))) for i in ids]


def stores_in_states(ids, first, second, reach: int, lat: str, lng: str):
    """Column: per id what the two states of its page say, (n0, n1, o0, o1); see :func:`stores_in_state`."""

    @F.pandas_udf(TOLD)
    def run(all_ids: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        import re

        patterns = [re.compile(p, re.ASCII) for p in (lat, lng)]
        out = []
        for own, x, y in zip(all_ids, a, b):
            own = [] if own is None else list(own)
            both = zip(stores_in_state(own, x, reach, *patterns), stores_in_state(own, y, reach, *patterns))
            out.append([{"n0": p[0], "n1": q[0], "o0": p[1], "o1": q[1]} for p, q in both])
        return pd.Series(out, dtype="object")

    return run(ids, first, second)


@F.pandas_udf(T.StructType([T.StructField("known", T.StringType()), T.StructField("places", TEXTS)]))
def restaurants_of(first: pd.Series, second: pd.Series) -> pd.DataFrame:
    found = [restaurants(a, b) or {"known": None, "places": None} for a, b in zip(first, second)]
    return pd.DataFrame(found, columns=["known", "places"])


addressed_object_of = _per_text(addressed_object, T.StringType())
places_of = _per_text(lambda t: places(load(t)), TEXTS)
