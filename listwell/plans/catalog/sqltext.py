"""DuckDB wording of the text rules, for the SQL twins. ASCII input is assumed where regexes decide."""

from __future__ import annotations

from listwell.functions import normalize as nz


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def collapsed(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def replaced(c: str, pattern: str, repl: str, flags: str = "gi") -> str:
    return f"regexp_replace({c}, {quoted(pattern)}, {quoted(repl)}, {quoted(flags)})"


def name_steps(source: str, key: str = "id", name: str = "name") -> str:
    """CTEs ending in ``names(key, clean)``: the name rule, one step a CTE."""
    places = ", ".join(quoted(p) for p in nz.LOCATIONS)
    slogans = " OR ".join(f"contains(lower(p), {quoted(m)})" for m in nz.SLOGAN_MARKS)
    tails = "n"
    for place in nz.LOCATIONS:
        tails = replaced(tails, rf"\s+{place}\s*$", "")
    platform_cut = replaced(collapsed(f"nfc_normalize({name})"), nz.PLATFORM_TAIL, "")
    return f"""
n1 AS (SELECT {key} AS k, regexp_replace({replaced(platform_cut, nz.PAREN_TAIL, '')}, ' [Il] ', ' | ', 'g') AS n FROM {source}),
n2 AS (SELECT k, list_transform(string_split(n, ' | '), lambda p: trim(p)) AS ps FROM n1),
n3 AS (SELECT k, ps, list_filter(ps, lambda p: NOT (lower(p) IN ({places}) OR {slogans})) AS ok FROM n2),
n4 AS (SELECT k, {replaced("CASE WHEN len(ok) > 0 THEN ok[1] ELSE ps[1] END", nz.BRANCH_TAIL, '', 'g')} AS n FROM n3),
n5 AS (SELECT k, string_split({collapsed(tails)}, ' ') AS ws FROM n4),
names AS (SELECT k, array_to_string(list_filter(ws, lambda w, i: i = 1 OR lower(w) <> lower(ws[i - 1])), ' ') AS clean FROM n5)"""


def address(c: str) -> str:
    text = collapsed(f"nfc_normalize(COALESCE({c}, ''))")
    for pattern, word in nz.ADDRESS_WORDS:
        text = replaced(text, pattern, word)
    return replaced(text, nz.POSTAL_GAP, r"\1 \2")


def address_steps(source: str, key: str = "id", col: str = "address") -> str:
    """CTEs ending in ``parts(k, street_number, street_name, city)``."""
    postal = r"'^(.*?)\b(\d{4})\s*([a-z]{2})?\b(.*)$'"
    number = r"'^(.*?)\b(\d+[a-z]?)\b(.*)$'"
    return f"""
a1 AS (SELECT {key} AS k, lower({collapsed(address(col))}) AS a FROM {source}),
a2 AS (SELECT k, a, regexp_matches(a, {postal}) AS zip, list_transform(string_split(a, ','), lambda p: trim(p)) AS cs FROM a1),
a3 AS (SELECT k, CASE WHEN zip THEN trim(regexp_extract(a, {postal}, 1), ' ,') WHEN len(cs) >= 2 THEN array_to_string(cs[1:len(cs)-1], ',') ELSE a END AS st,
  CASE WHEN zip THEN trim(split_part(trim(regexp_extract(a, {postal}, 4), ' ,'), ',', 1)) WHEN len(cs) >= 2 THEN cs[len(cs)] ELSE '' END AS city FROM a2),
a4 AS (SELECT k, city, regexp_extract(st, {number}, 2) AS no,
  CASE WHEN regexp_matches(st, {number}) THEN trim(trim(regexp_extract(st, {number}, 1)) || ' ' || trim(regexp_extract(st, {number}, 3))) ELSE st END AS st FROM a3),
parts AS (SELECT k, no AS street_number, trim(regexp_replace(st, '\\s+', ' ', 'g'), ' ,-') AS street_name, city FROM a4)"""


def lcs(a: str, b: str) -> str:
    """Common subsequence length of texts of up to 61 characters, by bit-parallel steps."""
    full = f"((1::BIGINT << len({a})) - 1)"
    mask = f"list_sum(list_transform(range(len({a})), lambda i: CASE WHEN {a}[i + 1] = c THEN 1::BIGINT << i ELSE 0 END))::BIGINT"
    run = (
        f"list_reduce(list_prepend({full}, list_transform(string_split({b}, ''), lambda c: {mask})), "
        f"lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full})"
    )
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE len({a}) - bit_count({run}) END"


def score_steps(pairs: str, out: str = "scores", tag: str = "f") -> str:
    """CTEs from ``pairs(a, b)`` to ``out(a, b, ratio, token_set, fuzz)``."""
    return f"""
{tag}1 AS (SELECT DISTINCT a, b FROM {pairs}),
{tag}2 AS (SELECT a, b, list_filter(list_distinct(string_split(a, ' ')), lambda t: t <> '') AS ta,
  list_filter(list_distinct(string_split(b, ' ')), lambda t: t <> '') AS tb FROM {tag}1),
{tag}3 AS (SELECT a, b, ta, tb, array_to_string(list_sort(list_filter(ta, lambda t: NOT list_contains(tb, t))), ' ') AS x,
  array_to_string(list_sort(list_filter(tb, lambda t: NOT list_contains(ta, t))), ' ') AS y,
  array_to_string(list_filter(ta, lambda t: list_contains(tb, t)), ' ') AS i FROM {tag}2),
{tag}4 AS (SELECT *, len(i) AS s, CASE WHEN i <> '' THEN 1 ELSE 0 END AS g, len(x) AS lx, len(y) AS ly,
  {lcs('a', 'b')} AS l, {lcs('x', 'y')} AS lxy FROM {tag}3),
{tag}5 AS (SELECT *, CASE WHEN len(a) + len(b) = 0 THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * l / (len(a) + len(b)) END AS ratio,
  CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0::DOUBLE WHEN i <> '' AND (x = '' OR y = '') THEN 100.0::DOUBLE
   ELSE GREATEST(100 - 100.0::DOUBLE * (lx + ly - 2 * lxy) / (2 * (s + g) + lx + ly),
     CASE WHEN s > 0 THEN 100 - 100.0::DOUBLE * (g + lx) / (2 * s + g + lx) ELSE 0 END,
     CASE WHEN s > 0 THEN 100 - 100.0::DOUBLE * (g + ly) / (2 * s + g + ly) ELSE 0 END) END AS token_set FROM {tag}4),
{out} AS (SELECT a, b, ratio, token_set, CASE WHEN a = '' AND b = '' THEN 100.0 WHEN a = '' OR b = '' THEN 0.0
  ELSE GREATEST(ratio, token_set) END AS fuzz FROM {tag}5)"""
