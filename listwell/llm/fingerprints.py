"""Document fingerprints: a homomorphic multiset hash over paragraphs, in Spark functions alone.

A paragraph (a text between line feeds) hashes to a wide vector: its number of word
windows, eight uniform numbers of 32 bits, and 124 counters, where counter i says how many
of the paragraph's word windows have bit i of their hashes set. A window is up to three
words of a line, counted from its start. A text's fingerprint is the sum of the
vectors of its paragraphs, modulo 2**32 for the uniform numbers and 2**30 for the rest.
Sums do not depend on order, and a paragraph is put in or taken out by adding or
subtracting its vector (``plus``, ``minus``) without the rest of the text.

The uniform numbers tell multisets of paragraphs apart. The counters also say how alike two
texts are: twice a counter less the number of windows is a random projection of the
multiset of windows, so the cosine of two such rows estimates the cosine of the multisets,
with a standard error of about 0.09.

Two counters share a long. Each has 30 bits and a spare one above that takes the carry of an
addition and is masked off after it. A text has at most 2**31 bytes and so fewer windows
than 31 bits can count, which makes the sums exact before they are reduced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwell.llm.common import numbered, staged

WINDOW = r"[^\x20\x09-\x0D]++(?:[\x20\x09\x0B-\x0D]++[^\x20\x09-\x0D]++){0,2}"
UNIFORM, HASHES, SHIFTS, LANES, LANE_BITS = 4, 2, 31, 2, 31
LANE, WORD = 2**30 - 1, 2**32 - 1
ONES = sum(1 << LANE_BITS * lane for lane in range(LANES))
MASKS = [LANE, *[WORD] * (2 * UNIFORM), *[LANE * ONES] * (HASHES * SHIFTS)]
UNITS = [1, *[1] * (2 * UNIFORM), *[ONES] * (HASHES * SHIFTS)]
PACKED = 1 + 2 * UNIFORM


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def vectors(rows: DataFrame, text: str, keys: list[str], name: str = "vector") -> DataFrame:
    """(keys, vector) of a text column. ``keys`` name a row.

    Null counts as an empty text, which is one empty paragraph. Windows become rows that are
    summed within their partition at once; where the rows are dealt by one of the keys
    already, nothing is shuffled.
    """
    value = F.coalesce(text, F.lit(""))
    windows, paragraphs = F.regexp_extract_all(value, F.lit(WINDOW), F.lit(0)), F.split(value, "\n")
    under = lambda i: F.transform(paragraphs, lambda p: F.xxhash64(F.lit(i), p)).alias(f"_p{i}")
    hashed = rows.select(*keys, windows.alias("_all"), *map(under, range(UNIFORM)))
    total = lambda c, part: F.aggregate(c, F.lit(0).cast("bigint"), lambda s, h: (s + part(h)).bitwiseAND(F.lit(WORD)))
    uniform = {}
    for i in range(UNIFORM):
        uniform[f"_u{2 * i}"] = total(f"_p{i}", lambda h: h.bitwiseAND(F.lit(WORD)))
        uniform[f"_u{2 * i + 1}"] = total(f"_p{i}", lambda h: F.shiftrightunsigned(h, 32))
    # Worked out before the windows become rows, or it would be done for each of them.
    whole = hashed.select(*keys, "_all", *[c.alias(n) for n, c in uniform.items()])
    found = whole.select(*keys, *uniform, F.explode_outer("_all").alias("_w"))
    # A text without windows has one row without a window, whose bits are all 0.
    bits = [F.when(F.col("_w").isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(F.lit(i), "_w")).alias(f"_h{i}") for i in range(HASHES)]
    found = found.select(*keys, *uniform, "_w", *bits)
    counters = [F.sum(F.shiftright(f"_h{i}", s).bitwiseAND(F.lit(ONES))).alias(f"_c{i}_{s}") for i in range(HASHES) for s in range(SHIFTS)]
    summed = found.groupBy(*keys, *uniform).agg(F.count("_w").alias("_n"), *counters)
    reduced = lambda c, mask: F.col(c).bitwiseAND(F.lit(mask))
    packed = [reduced(f"_c{i}_{s}", LANE * ONES) for i in range(HASHES) for s in range(SHIFTS)]
    return summed.select(*keys, F.array(reduced("_n", LANE), *[F.col(n) for n in uniform], *packed).alias(name))


def plus(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of both."""
    masks = _longs(MASKS)
    return F.transform(a, lambda x, i: (x + F.get(b, i)).bitwiseAND(F.get(masks, i)))


def minus(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of ``a`` without those of ``b``."""
    masks, units = _longs(MASKS), _longs(UNITS)
    return F.transform(a, lambda x, i: (x + F.get(b, i).bitwiseXOR(F.get(masks, i)) + F.get(units, i)).bitwiseAND(F.get(masks, i)))


def signed(vector: Column) -> Column:
    """Twice each counter less the number of windows, as a signed residue: what likeness is read from."""
    half, n = 2**29, F.get(vector, F.lit(0))
    one = lambda p, lane: (
        (F.shiftright(p, LANE_BITS * lane).bitwiseAND(F.lit(LANE)) * 2 - n + half).bitwiseAND(F.lit(LANE)) - half
    ).cast("double")
    packed = F.slice(vector, PACKED + 1, HASHES * SHIFTS)
    return F.flatten(F.transform(packed, lambda p: F.array(*[one(p, lane) for lane in range(LANES)])))


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Adds how alike two fingerprints are, 0 to 1: 1 for equal ones, 0 where just one has no window."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, t: s + t)
    rows = df.withColumns({"_a": signed(F.col(a)), "_b": signed(F.col(b))})
    rows = rows.withColumns({"_ab": dot(F.col("_a"), F.col("_b")), "_aa": dot(F.col("_a"), F.col("_a")), "_bb": dot(F.col("_b"), F.col("_b"))})
    cosine = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_ab") / F.sqrt(F.col("_aa") * F.col("_bb"))))
    value = F.when(F.col(a) == F.col(b), 1.0).when((F.col("_aa") == 0) | (F.col("_bb") == 0), 0.0).otherwise(cosine)
    return rows.withColumn(name, value).drop("_a", "_b", "_ab", "_aa", "_bb")


def as_text(vector: Column) -> Column:
    """A fingerprint in hexadecimal, 16 digits a long."""
    return F.array_join(F.transform(vector, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _following(rows: DataFrame) -> DataFrame:
    """(row, doc_id, n_chars, copies, next_row) of every different row of (row, doc_id, n_chars).

    Ids are ranked by ranges, so no task sees them all; the first follows the last.
    """
    rows = staged(rows.groupBy("row", "doc_id", "n_chars").agg(F.count("*").alias("copies")))
    ranked = numbered(rows.groupBy("doc_id").agg(F.min("row").alias("row")), ["doc_id"])
    total = ranked.agg(F.count("*").alias("total"))
    before = ranked.crossJoin(F.broadcast(total)).select(
        F.pmod(F.col("number") - 1, F.col("total")).alias("number"), F.col("row").alias("next_row")
    )
    ring = ranked.join(before, "number").select(F.col("doc_id").alias("for_id"), "next_row")
    return rows.join(ring, F.col("doc_id").eqNullSafe(F.col("for_id"))).drop("for_id")


def edited_documents(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_chars, copies, next_row, text, edited) of every different (doc_id, text).

    ``row`` is a 128-bit digest of both, ``copies`` says how many rows they have. The edited text ends in the
    head of the next document instead of its own last half. The next document is that of the
    next greater id; null comes before all ids and the first follows the last. Where an id has several texts,
    the one with the least digest speaks for it, and all have the same next. Texts are shuffled
    once, as both joins read one exchange; beside them only heads travel.
    """
    text = F.coalesce("text", F.lit(""))
    row = F.unhex(F.substring(F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text), 256), 1, 32)).alias("row")
    rows = docs.select(row, text.alias("text")).dropDuplicates(["row"])
    wanted = _following(docs.select(row, "doc_id", F.length(text).alias("n_chars"))).withColumnRenamed("row", "for_row")
    half = F.expr("n_chars div 2").cast("int")
    heads = rows.join(wanted, F.col("row") == F.col("next_row")).select(
        "for_row", "doc_id", "n_chars", "copies", "next_row", F.col("text").substr(F.lit(1), half).alias("head")
    )
    kept = F.col("text").substr(F.lit(1), F.col("n_chars") - half)
    joined = rows.join(heads, F.col("row") == F.col("for_row"))
    return joined.select("row", "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), "copies", "next_row", "text", F.concat(kept, "head").alias("edited"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, vector, edited_vector, near_edited, near_next) of every row.

    See :func:`edited_documents` for the edited text and the next document. Null counts as empty. A text without a
    window is like another such text only if their fingerprints are equal. Repeated rows are worked on once and
    give equal rows.
    """
    own = ["row", "doc_id", "n_chars", "copies", "next_row", "edited_sha256"]
    both = edited_documents(docs).select(*own[:-1], F.sha2("edited", 256).alias("edited_sha256"), F.array("text", "edited").alias("texts"))
    each = vectors(both.select(*own, F.posexplode("texts").alias("which", "body")), "body", [*own, "which"])
    side = lambda which: F.max(F.when(F.col("which") == which, F.col("vector")))
    made = staged(each.groupBy(*own).agg(side(0).alias("vector"), side(1).alias("edited_vector")))
    after = made.select(F.col("row").alias("next_row"), F.col("vector").alias("next_vector"))
    near = with_likeness(with_likeness(made.join(after, "next_row"), "vector", "edited_vector", "near_edited"), "vector", "next_vector", "near_next")
    # Copies come back in stretches, so that no row holds a long list of them.
    stretch = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(copies - 1) div 1000"))).alias("stretch")
    results = ["doc_id", "n_chars", "edited_sha256", "vector", "edited_vector", "near_edited", "near_next"]
    rows = near.select(*results, "copies", stretch)
    rest = F.least(F.col("copies") - F.col("stretch") * 1000, F.lit(1000)).cast("int")
    return rows.select(*results, F.explode(F.array_repeat(F.lit(0), rest)).alias("copy")).drop("copy")
