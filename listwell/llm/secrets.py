"""Secret scans, in columns only: three patterns, and entropy in sliding windows.

A pattern's matches come from the pieces of text around them: the pieces and the matches
are two arrays, and a match starts after all pieces and matches before it.

Candidate strings are long runs of key characters. A window moves over the candidate; the
counts of its characters, and the sum of c log2 c over them, change by one character that
enters and one that leaves. Each character class has its own window and least entropy; the
windows that reach it are joined to one span. Base spans and parts that an allow list names are
blanked before candidates are looked for, so what stands beside them is scanned.

Every step is linear in a text: what a lambda uses again and again is bound to a name first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwell.llm.common import let

#: Patterns of the base kinds, in the order of ties. The rest of a match that is too short is not searched again.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

#: Candidates of the entropy scan: at least CANDIDATE key characters, with a digit.
CANDIDATE = 20
KEYS = r"[A-Za-z0-9+/_=-]{20,}"
#: (what the whole candidate is made of, window, least entropy in bits)
CLASSES = ((r"^[0-9]+$", 24, 3.1), (r"^[0-9a-fA-F]+$", 20, 3.0), (r"^[A-Z0-9]+$", 20, 3.4), (r"^[A-Za-z0-9+/_=-]+$", 20, 3.6))
#: Strings that look random and are public: parts, between slashes, with an example's word or a run of the alphabet;
ALLOWED_PART = r"(?<![A-Za-z0-9+_=-])[A-Za-z0-9+_=-]*?(?i:example|sample|dummy|placeholder|xxxx|abcdefgh|01234567|12345678)[A-Za-z0-9+_=-]*"
#: whole candidates that are unique ids or hashes of content.
ALLOWED = (r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$", r"(?i)^sha(1|256|512)[-_=]")
#: What is blanked before candidates are looked for: matches of the base kinds that are long enough.
BASE_SPAN = f"{ASSIGN[:-2]}{{{ASSIGN_VALUE},}})|{ACCESS}|{HEX}"
STRETCH = 64
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


def _spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """array<struct<kind, start, end, found>> of a pattern's matches; ``keep`` is a test of a match.

    Lengths of gaps and matches are added up once for each match; the spans are read off the running sums.
    """
    found, around = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    number = F.lit(KINDS.index(kind))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,found:string>>")

    def placed(hits: Column) -> Column:
        gaps = F.transform(around, F.length)
        one = lambda gap, hit: F.struct(gap.cast("bigint").alias("gap"), F.length(hit).cast("bigint").alias("size"), hit.alias("found"))
        return let(F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, one), walked)

    def walked(steps: Column) -> Column:
        # Sums of the steps before each one, in stretches, so that no long list is copied for every match.
        total = lambda part: F.aggregate(part, F.lit(0).cast("bigint"), lambda s, x: s + x["gap"] + x["size"])
        last = F.call_function("div", F.size(steps) - 1, F.lit(STRETCH)).cast("int")
        stretches = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(steps, i * STRETCH + 1, F.lit(STRETCH)))
        return let(stretches, lambda parts: let(F.transform(parts, total), lambda sums: F.flatten(F.transform(parts, lambda part, i: spread(part, total_before(sums, i))))))

    def total_before(sums: Column, i: Column) -> Column:
        return F.aggregate(F.slice(sums, F.lit(1), i), F.lit(0).cast("bigint"), lambda s, x: s + x)

    def spread(part: Column, before: Column) -> Column:
        return let(before, lambda at: F.transform(part, lambda x, k: let(
            at + F.aggregate(F.slice(part, F.lit(1), k), F.lit(0).cast("bigint"), lambda s, y: s + y["gap"] + y["size"]) + x["gap"],
            lambda start: F.struct(number.alias("kind"), start.alias("start"), (start + x["size"]).alias("end"), x["found"].alias("found")),
        )))

    some = F.when(text.rlike(pattern), let(found, placed)).otherwise(none)
    return F.filter(some, keep) if keep else some


def _blanked(text: Column, pattern: str) -> Column:
    """The text with as many spaces in place of each match."""
    found, around = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    filled = F.zip_with(around, found, lambda gap, hit: F.concat(gap, F.coalesce(F.repeat(F.lit(" "), F.length(hit)), F.lit(""))))
    return F.when(text.rlike(pattern), F.array_join(filled, "")).otherwise(text)


def hot_windows(candidate: Column) -> Column:
    """struct<first, last>: from the start of the first to the end of the last window that reaches its class's entropy; null if none."""
    bounds = F.struct(F.lit(CLASSES[-1][1]).alias("w"), F.lit(CLASSES[-1][2]).alias("least"))
    for pattern, w, e in reversed(CLASSES[:-1]):
        bounds = F.when(candidate.rlike(pattern), F.struct(F.lit(w).alias("w"), F.lit(e).alias("least"))).otherwise(bounds)
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    term = lambda c: F.when(c > 0, c * F.log2(c.cast("double"))).otherwise(0.0)
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"),
        F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"),
    )

    def moved(acc, x):
        """One character enters, and one leaves once the window is full."""
        code, out = x["code"], x["out"]
        c_in = F.element_at(acc["counts"], code + 1)
        gained = acc["sum"] - term(c_in) + term(c_in + 1)
        c_out = F.element_at(acc["counts"], out + 1) + F.when(out == code, 1).otherwise(0)
        summed = F.when(x["full"], gained - term(c_out) + term(c_out - 1)).otherwise(gained)
        n = F.least(acc["n"] + 1, x["w"])
        entropy = F.log2(n.cast("double")) - summed / n
        hit = (x["i"] + 1 >= x["w"]) & (entropy >= x["least"])
        counts = F.transform(acc["counts"], lambda c, k: c + F.when(k == code, 1).otherwise(0) - F.when(x["full"] & (k == out), 1).otherwise(0))
        return F.struct(
            counts.alias("counts"), summed.alias("sum"), n.alias("n"),
            F.when(hit, F.coalesce(acc["first"], x["i"] + 1 - x["w"])).otherwise(acc["first"]).alias("first"),
            F.when(hit, x["i"] + 1).otherwise(acc["last"]).alias("last"),
        )

    def scanned(codes: Column, bound: Column) -> Column:
        w = bound["w"]
        steps = F.transform(codes, lambda c, i: F.struct(
            i.alias("i"), c.alias("code"), w.alias("w"), bound["least"].alias("least"), (i >= w).alias("full"),
            F.when(i >= w, F.get(codes, i - w)).otherwise(F.lit(0)).alias("out"),
        ))
        return F.aggregate(steps, start, moved, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))

    return let(codes, lambda known: let(bounds, lambda bound: scanned(known, bound)))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_entropy, base, spans), one row per row of ``docs``.

    ``base`` and ``spans`` list kind:start:end by start, then kind, with commas; positions
    count code points, the end is exclusive. ``spans`` adds the entropy spans, which never
    replace or overlap a base span, but may touch one. A null text is empty; texts without secrets have empty
    lists. Ids may be null or repeat: each row is answered by itself. Other columns are left out.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    value = lambda s: F.length(F.regexp_extract(s["found"], "^" + ASSIGN, 1)) >= ASSIGN_VALUE
    base = docs.select(F.col(doc_id).alias("doc_id"), t.alias("t")).select(
        "doc_id", _spans(F.col("t"), ASSIGN, "assign", value).alias("a"), _spans(F.col("t"), ACCESS, "access").alias("k"), _spans(F.col("t"), HEX, "hex").alias("h"),
        _blanked(_blanked(F.col("t"), BASE_SPAN), ALLOWED_PART).alias("rest"),
    ).withColumn("c", _spans(F.col("rest"), KEYS, "entropy", lambda s: s["found"].rlike("[0-9]"))).withColumn("b", F.concat("a", "k", "h"))
    open_ = F.filter("c", lambda s: ~(s["found"].rlike(ALLOWED[0]) | s["found"].rlike(ALLOWED[1])))
    hot = F.transform(F.col("o"), lambda s: F.struct(s.alias("s"), hot_windows(s["found"]).alias("w")))
    spans = F.transform(F.filter("w", lambda x: x["w"]["first"].isNotNull()), lambda x: F.struct(
        x["s"]["kind"].alias("kind"), (x["s"]["start"] + x["w"]["first"]).cast("bigint").alias("start"), (x["s"]["start"] + x["w"]["last"]).cast("bigint").alias("end"), x["s"]["found"].alias("found")
    ))
    # Base spans of different kinds can overlap, and what is left of one of them then looks like a candidate.
    added = F.filter(spans, lambda s: ~F.exists("b", lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"])))
    size = lambda c: F.size(c).cast("bigint")
    none = F.array().cast("array<struct<s:struct<kind:int,start:bigint,end:bigint,found:string>,w:struct<first:int,last:int>>>")
    return (
        base.withColumn("o", open_).withColumn("w", F.when(F.size("o") > 0, hot).otherwise(none)).withColumn("e", added)
        .select(
            "doc_id", size("a").alias("n_assign"), size("k").alias("n_access"), size("h").alias("n_hex"), size("e").alias("n_entropy"),
            _listed(F.col("b")).alias("base"), _listed(F.concat("b", "e")).alias("spans"),
        )
    )
