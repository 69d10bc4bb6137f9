"""URL filter: rules first, then templates of paths judged by what is known of their pages.

A path-template tree per host is grown level by level. Segments that few of a node's URLs
share become one wildcard; frequent segments stay, and those whose share of bad pages does
not differ from the node's (a test of two proportions) are merged into one branch. A
template is rejected when its share of bad pages, smoothed by that of its host and of all
hosts, reaches a threshold.

Every level is two aggregates and two equi-joins over distinct paths, with nothing gathered
per host; a host may hold a third of all URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwell.llm.common import ascii_lower
from listwell.session import cut_lineage

#: (host, start of the path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    return F.when(url.contains("://"), ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))).otherwise("")


def path_of(url: Column) -> Column:
    return F.when(url.contains("://"), F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def _rest(url: Column) -> Column:
    return url.substr(F.instr(url, "://") + 3, F.length(url))


def _ruled(rules, host: Column, path: Column, value) -> Column:
    found = F.lit(None).cast("string")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the last to be wrapped is asked first
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, value(name, start, verdict)).otherwise(found)
    return found


def templates(
    paths: DataFrame, min_share: float = 0.02, min_rows: int = 4, z: float = 1.96, eager_depth: int = 8
) -> DataFrame:
    """(host, path, template) for distinct (host, path, n, bad, labelled).

    A segment is constant if at least ``min_rows`` URLs and ``min_share`` of its node have
    it, and else joins the wildcard ``*``. Constants whose share of bad pages is within ``z``
    standard errors of the node's merge into ``~``; ``=name`` is a constant of its own and
    ``$`` the end. From ``eager_depth`` segments on, only nodes that still have pages of either label are
    opened, to any depth; all below another node belongs to its template, ``...``.
    """
    held = cut_lineage(
        paths.select("host", "path", "n", "bad", "labelled", F.split(F.regexp_replace("path", "^/", ""), "/").alias("segments"), F.lit("").alias("template"), F.lit(False).alias("shut"))
    )
    deepest = held.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(deepest):
        if level >= eager_depth:
            below = held.where(~F.col("shut") & (F.size("segments") > level)).groupBy("host", "template").agg(F.sum("bad").alias("b"), F.sum("labelled").alias("l"))
            mixed = cut_lineage(below.where("b > 0 AND b < l").select("host", "template", F.lit(True).alias("mixed")))
            if mixed.isEmpty():
                held = held.withColumn("shut", F.col("shut") | (F.size("segments") > level))
                break
            held = held.join(mixed, ["host", "template"], "left")
            held = held.withColumn("shut", F.col("shut") | ((F.size("segments") > level) & F.col("mixed").isNull())).drop("mixed")
        now = held.withColumn("segment", F.coalesce(F.get("segments", F.lit(level)), F.lit(""))).withColumn(
            "open", ~F.col("shut") & (F.size("segments") > level)
        )
        branch = now.where("open").groupBy("host", "template", "segment").agg(
            F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")
        )
        node = branch.groupBy("host", "template").agg(
            F.sum("n").alias("all_n"), F.try_divide(F.sum("bad"), F.sum("labelled")).alias("share")
        )
        error = F.sqrt(F.try_divide(F.col("share") * (1 - F.col("share")), F.col("labelled")))
        alike = (F.col("labelled") == 0) | (F.abs(F.try_divide(F.col("bad"), F.col("labelled")) - F.col("share")) <= z * error)
        step = (
            branch.join(node, ["host", "template"])
            .withColumn(
                "step",
                F.when((F.col("n") < min_rows) | (F.col("n") < min_share * F.col("all_n")), "*")
                .when(F.coalesce(alike, F.lit(True)), "~")
                .otherwise(F.concat(F.lit("="), "segment")),
            )
            .select("host", "template", "segment", F.lit(True).alias("open"), "step")
        )
        held = cut_lineage(
            now.join(step, ["host", "template", "segment", "open"], "left").select(
                "host", "path", "n", "bad", "labelled", "segments", "shut",
                F.when(F.col("open"), F.concat("template", F.lit("/"), "step")).otherwise(F.col("template")).alias("template"),
            )
        )
    ended = F.when(F.col("shut"), "/...").otherwise("/$")
    return held.select("host", "path", "n", "bad", "labelled", F.concat("template", ended).alias("template"))


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules=RULES, page_id: str = "page_id", url: str = "url",
    weight: float = 20.0, threshold: float = 0.5,
) -> DataFrame:
    """(page_id, host, path, rule, template, bad_share, verdict) for every row of ``pages``.

    ``labels`` is (page_id, bad boolean); ids that it lacks are unlabelled, and an id with
    several labels is bad if one says so. The longest fitting rule decides, else the
    template: it is blocked if (bad + weight * host's share) / (labelled + weight) reaches
    ``threshold``, where the host's share is smoothed in the same way by that of all hosts.

    A null url, or one without ``://``, has an empty host and path and a template of its own.
    Null and repeated ids keep all their rows. Without any label nothing but rules blocks.
    Columns of the inputs other than those named are left out.
    """
    u = F.col("_url")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_url")).select(
        "page_id", host_of(u).alias("host"), path_of(u).alias("path")
    ).withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "path")})
    known = labels.select(F.col(labels.columns[0]).alias("page_id"), F.col(labels.columns[1]).cast("int").alias("_bad")).groupBy("page_id").agg(
        F.max("_bad").alias("_bad")
    )
    paths = rows.join(known, "page_id", "left").groupBy("host", "path").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad"), F.count("_bad").alias("labelled")
    )
    tree = templates(paths)
    by_template = tree.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"))
    by_host = tree.groupBy("host").agg(F.sum("bad").alias("host_bad"), F.sum("labelled").alias("host_labelled"))
    overall = tree.agg(F.sum("bad"), F.sum("labelled")).first()
    prior = (overall[0] / overall[1]) if overall[1] else 0.0
    host_share = (F.col("host_bad") + weight * prior) / (F.col("host_labelled") + weight)
    judged = by_template.join(by_host, "host").select(
        "host", "template", ((F.col("bad") + weight * host_share) / (F.col("labelled") + weight)).alias("bad_share")
    )
    of_path = tree.select("host", "path", "template").join(judged, ["host", "template"])
    host, path = F.col("host"), F.col("path")
    method = F.when(F.col("bad_share") >= threshold, "block").otherwise("allow")
    return rows.join(of_path, ["host", "path"]).select(
        "page_id", "host", "path",
        _ruled(rules, host, path, lambda name, start, _: F.lit(name + start)).alias("rule"),
        "template", "bad_share",
        F.coalesce(_ruled(rules, host, path, lambda *r: F.lit(r[2])), method).alias("verdict"),
    )
