"""Quality rules by distribution divergence, in columns only.

A document's histogram of character classes and its histogram of the most common words of
its language are compared with the language's own by the Jensen-Shannon distance. The
language's own is the mean of the histograms of its distinct texts that pass the base rules:
neither many copies nor a long text weigh more than one. Short documents, whose histograms are noise, are not judged by a
distance: each has a least count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listwell.llm.common import ascii_lower, let, staged, words

#: Character classes, each as the characters that are not in it; what is in none is a letter.
CLASSES = {
    "upper": r"[^\p{Lu}]+", "digit": r"[^0-9]+", "mark": r"[^.,;:!?'\"()\-]+", "symbol": r"[^#*$%&|<>]+", "other": r"[\p{L}0-9.,;:!?'\"()\-#*$%&|<>\s]+",
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COMMON = 24
MIN_WORDS = 50
MAX_CHARS = 0.27
MAX_WORDS = 0.19
#: The distance of an honest sample of n words from its source is noise of the order 1 / sqrt(n).
WORD_NOISE = 1.3


def _windows(w: Column) -> Column:
    """Hashes of all 3-word windows; none where there are fewer than two."""
    n = F.size(w)
    return F.when(n >= 4, F.zip_with(
        F.slice(w, 1, F.greatest(n - 2, F.lit(0))),
        F.zip_with(F.slice(w, 2, F.greatest(n - 2, F.lit(0))), F.slice(w, 3, F.greatest(n - 2, F.lit(0))), lambda b, c: F.xxhash64(b, c)),
        lambda a, bc: F.xxhash64(a, bc),
    )).otherwise(F.array().cast("array<bigint>"))


def _repeated(h: Column) -> Column:
    """How many words the windows that come again cover: in sorted order equal windows are neighbours."""

    def covered(p):
        return F.aggregate(
            F.sequence(F.lit(0), F.greatest(F.size(p) - 1, F.lit(0))), F.lit(0).cast("bigint"),
            lambda acc, i: acc + F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - F.get(p, i), F.lit(3))),
        )

    def places(o):
        again = F.filter(o, lambda x, i: (x["h"] == F.get(o, i + 1)["h"]) | (x["h"] == F.get(o, i - 1)["h"]))
        return let(F.array_sort(F.transform(again, lambda x: x["i"])), covered)

    ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return F.when(F.size(h) > F.size(F.array_distinct(h)), let(ordered, places)).otherwise(0).cast("bigint")


def measures(base: DataFrame) -> DataFrame:
    """(doc_id, text_hash, t_hash, lang, counts of BASE, counts per character class) of (doc_id, text, lang, text_hash, t_hash)."""
    t = F.coalesce(F.col("text"), F.lit(""))
    count = lambda others: F.length(F.regexp_replace(t, others, "")).cast("bigint")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    repeats = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))
    of_words = let(words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"), F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"), let(_windows(w), _repeated).alias("n_repeat_words"),
    ))
    return base.select(
        "doc_id", "text_hash", "t_hash", "lang", *[count(p).alias("n_symbols" if name == "symbol" else f"n_{name}") for name, p in CLASSES.items()],
        F.length(t).cast("bigint").alias("n_chars"), repeats.alias("n_dup_lines"), of_words.alias("w"),
    ).select("*", "w.*").drop("w")


def common_words(held: DataFrame, special: DataFrame, n: int = COMMON) -> DataFrame:
    """(lang, word, share): the n words with the greatest mean share in the distinct texts of each language; ties by code points.

    ``special`` (t_hash, rows) has the texts that come more than once, with the number of their
    rows, and those of MIN_WORDS or more that fail, with null. Sums are rounded, as the order of
    rows changes their last bits.
    """
    counted = let(words(ascii_lower(F.col("text"))), lambda w: F.struct(F.size(w).alias("n"), F.when(F.size(w) >= MIN_WORDS, w).alias("w")))
    marked = special.select("t_hash", "rows", F.lit(True).alias("listed"))
    texts = held.select("lang", "t_hash", "text").join(marked, "t_hash", "left").where(F.col("listed").isNull() | F.col("rows").isNotNull())
    weight = 1 / (F.col("of.n").cast("double") * F.coalesce("rows", F.lit(1)))
    each = texts.select("lang", "rows", counted.alias("of")).select("lang", weight.alias("weight"), F.explode("of.w").alias("word"))
    each = each.groupBy("lang", "word").agg(F.round(F.sum("weight"), 9).alias("n"))
    # a first cut within parts keeps the window from seeing a whole language in one task
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("word"), F.lit(64))).orderBy(F.desc("n"), "word")
    first = each.withColumn("r", F.row_number().over(part)).where(F.col("r") <= n)
    top = first.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(F.col("r") <= n)
    totals = each.groupBy("lang").agg(F.sum("n").alias("all"))
    return top.join(totals, "lang").select("lang", "word", (F.col("n") / F.col("all")).alias("share"))


def _half(p: Column, q: Column) -> Column:
    """p log2 (p / mean of p and q), 0 for p = 0."""
    return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)


def quality(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    max_chars: float = MAX_CHARS, max_words: float = MAX_WORDS, word_noise: float = WORD_NOISE, judged_from: int = MIN_WORDS,
) -> DataFrame:
    """(doc_id, text_hash, measures, char_distance, word_distance, base_failed, kept), a row per row of ``docs``.

    ``base_failed``: fewer than 50 words, or over half of them in repeated 3-word windows.
    ``kept`` is false if base_failed, if the character distance is over ``max_chars``, or if
    the common-word distance is over ``max_words + word_noise / sqrt(n_words)``. The
    histogram of words has a bar for each common word and one for all others. Documents of
    fewer than ``judged_from`` words have no distances (null), nor have those of a language in which
    every text is base_failed. Distances lie in [0, 1].

    A null text has no words and fails; a null lang is a language of its own. Rows that are
    equal in id, text and lang get the same answer, each its own row. An empty table gives
    no rows. Other columns are left out.
    """
    held = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.concat(F.lit("="), F.col(lang)), F.lit("-")).alias("lang"),
        F.xxhash64(F.col(doc_id), F.col(text), F.col(lang)).alias("text_hash"),
    ).withColumn("t_hash", F.xxhash64("text", "lang"))
    found = measures(held)
    own = ("doc_id", "text_hash", "t_hash", "lang")
    m = staged(found.groupBy(*own).agg(F.count("*").alias("copies"), *[F.any_value(c).alias(c) for c in found.columns if c not in own]))
    rest = F.col("n_chars") - F.col("word_chars")
    named = {c: F.col("n_symbols" if c == "symbol" else f"n_{c}") for c in CLASSES}
    letters = F.greatest(F.col("word_chars") - sum(named.values(), F.lit(0)), F.lit(0).cast("bigint"))
    classes = {"space": rest, "letter": letters} | named
    m = m.withColumns({f"c_{k}": v.cast("double") for k, v in classes.items()})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    own = sum((F.col(f"c_{k}") for k in classes), F.lit(0.0))
    distinct = m.where(F.col("n_words") >= MIN_WORDS).groupBy("lang", "t_hash").agg(
        F.sum("copies").alias("rows"), F.any_value(failed).alias("failed"), *[F.any_value(F.col(f"c_{k}") / own).alias(f"p_{k}") for k in classes]
    )
    by_lang = distinct.where(~F.col("failed")).groupBy("lang").agg(*[F.sum(f"p_{k}").alias(f"l_{k}") for k in classes])
    # written apart, so that Spark knows its size: where few texts are special, no text is shuffled for their join
    special = staged(distinct.where(F.col("failed") | (F.col("rows") > 1)).select("t_hash", F.when(~F.col("failed"), F.col("rows")).alias("rows")))

    common = common_words(held, special)
    hits = (
        held.select("doc_id", "text_hash", "lang", F.explode(words(ascii_lower(F.col("text")))).alias("word"))
        .join(F.broadcast(common), ["lang", "word"])  # COMMON rows for each language
        .groupBy("doc_id", "text_hash", "word").agg(F.count("*").alias("n"), F.any_value("share").alias("share"))
        .groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("n", "share")).alias("bars"))  # COMMON bars at most
        .withColumnsRenamed({"doc_id": "h_id", "text_hash": "h_hash"})
    )
    covered = common.groupBy("lang").agg(F.sum("share").alias("q_all"))
    full = (
        m.join(F.broadcast(by_lang), "lang", "left").join(F.broadcast(covered), "lang", "left")  # a row for each language
        .join(hits, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_hash") == F.col("h_hash")), "left")
    )
    langs = sum((F.col(f"l_{k}") for k in classes), F.lit(0.0))
    chars = F.lit(0.0)
    for k in classes:
        p, q = F.col(f"c_{k}") / own, F.col(f"l_{k}") / langs
        chars = chars + _half(p, q) + _half(q, p)
    n = (F.col("n_words") * F.col("copies")).cast("double")
    bars = F.coalesce(F.col("bars"), F.array().cast("array<struct<n:bigint,share:double>>"))
    present = F.aggregate(bars, F.lit(0.0), lambda acc, b: acc + _half(b["n"] / n, b["share"]) + _half(b["share"], b["n"] / n))
    q_seen = F.aggregate(bars, F.lit(0.0), lambda acc, b: acc + b["share"])
    p_seen = F.aggregate(bars, F.lit(0.0), lambda acc, b: acc + b["n"] / n)
    q_all = F.coalesce("q_all", F.lit(0.0))
    p_rest, q_rest = F.greatest(1 - p_seen, F.lit(0.0)), F.greatest(1 - q_all, F.lit(0.0))
    word = present + F.greatest(q_all - q_seen, F.lit(0.0)) + _half(p_rest, q_rest) + _half(q_rest, p_rest)
    root = lambda x: F.sqrt(F.greatest(x / 2, F.lit(0.0)))
    measured = (F.col("n_words") >= judged_from) & langs.isNotNull()
    judged = full.select(
        "doc_id", "text_hash", *BASE, "copies", F.when(measured, root(chars)).alias("char_distance"),
        F.when(measured, root(word)).alias("word_distance"), failed.alias("base_failed"),
    )
    far = (F.coalesce("char_distance", F.lit(0.0)) > max_chars) | (
        F.coalesce("word_distance", F.lit(0.0)) > max_words + word_noise / F.sqrt("n_words")
    )
    each = judged.withColumn("kept", ~(F.col("base_failed") | far)).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return each.drop("copies", "copy")
