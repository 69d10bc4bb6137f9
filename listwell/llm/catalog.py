"""Registered corpus queries: ``name: (build(spark, sf_dir), sql or None)``."""

from __future__ import annotations

from pyspark.sql import functions as F

from listwell.llm.bpe import token_digests
from listwell.llm.collocations import best_per_language, collocations
from listwell.llm.common import shared_folder, staged, table
from listwell.llm.fingerprints import as_text, fingerprints
from listwell.llm.mixing import mix
from listwell.llm.near_lines import near_lines
from listwell.llm.near_vectors import near_vectors
from listwell.llm.ngram_trie import score_documents
from listwell.llm.prefix_trie import ids_digests, prefix_trie, rebuilt, turns_in_order
from listwell.llm.quality import BASE, quality
from listwell.llm.secrets import secrets
from listwell.llm.shingle_join import shingle_join
from listwell.llm.token_files import read_digests, write_token_files
from listwell.llm.url_templates import judge_urls, path_of


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1(spark, sf_dir):
    return token_digests(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"), tokenizer_pattern())


def op2(spark, sf_dir):
    """A page shows the document that the last number of its path names; bad is one of low quality or toxic."""
    pages = table(spark, sf_dir, "pages")
    shown = pages.select("page_id", F.regexp_extract(path_of(F.col("url")), r"([0-9]{1,18})[^0-9]*$", 1).try_cast("bigint").alias("doc_id"))
    known = table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return judge_urls(pages, shown.join(known, "doc_id").select("page_id", "bad"))


def op3(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"))


def op4(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5(spark, sf_dir):
    kept = near_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.coalesce("dropped_numbers", F.array().cast("array<int>"))
    return kept.select(
        "doc_id", F.size(gone).cast("bigint").alias("n_dropped"), F.array_join(gone.cast("array<string>"), ",").alias("dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def op6(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))


def op7(spark, sf_dir):
    return shingle_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents")).select("doc_id", *BASE, "base_failed", "kept")


def op9(spark, sf_dir):
    found = secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op10(spark, sf_dir):
    path = shared_folder(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"))
    return read_digests(spark, path)


def op11(spark, sf_dir):
    return best_per_language(collocations(table(spark, sf_dir, "documents")))


def op12(spark, sf_dir):
    """Every conversation begins as that of its hundred does, for as many turns as its checksum says."""
    return rebuilt_trie(table(spark, sf_dir, "conversations"))


def rebuilt_trie(conversations):
    turns = staged(turns_in_order(conversations))
    ids = turns.select("conv_id").distinct()
    conv_id = F.col("conv_id")
    made = rebuilt(turns, ids, conv_id - conv_id % 100, (F.crc32(conv_id.cast("string")) % 6).cast("int"), 5)
    nodes, ends = prefix_trie(made, ids)
    return nodes.join(ids_digests(ends), "id", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op13(spark, sf_dir):
    made = fingerprints(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("vector")).alias("fingerprint"),
        as_text(F.col("edited_vector")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON a = vec_id
"""

OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * inter >= 85 * (x.n + y.n - inter)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN least ON a = d.doc_id
"""

OP11_SQL = r"""
WITH p AS (
  SELECT lang, row_number() OVER () AS id, words FROM (
    SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
    )
  )
), g AS (
  SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM p, (VALUES (1), (2), (3)) AS t(m)) GROUP BY ALL
), totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE m = 1 GROUP BY lang
), c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE m > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.phrase, c.a, c.m, k, x.f AS l, y.f AS r, (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM c, (VALUES (1), (2)) AS t(k)
  JOIN g x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ') AND x.m = k
  JOIN g y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ') AND y.m = c.m - k
  WHERE k < c.m
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, part, max(a) AS a FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM c WHERE m = 3) GROUP BY lang, part
)
SELECT b.lang, CAST(row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, phrase) AS BIGINT) AS rank, phrase, b.a, l, r, n, CAST(score AS BIGINT) AS score
FROM best b JOIN totals USING (lang) LEFT JOIN longer o ON o.lang = b.lang AND o.part = b.phrase
WHERE o.a IS NULL OR 100 * o.a < 50 * b.a QUALIFY rank <= 2000
"""

OP12_SQL = """
WITH c AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), checked AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: list_transform(range(8), lambda i: CAST((ascii(d) >> CAST(i AS INTEGER)) & 1 AS BIGINT))))),
    lambda a, b: xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END))) % 6 AS h FROM c
), lens AS (SELECT conv_id, max(pos) AS n FROM c GROUP BY conv_id
), turns AS (
  SELECT i.conv_id, c.pos - i.h + least(i.h, coalesce(l.n, 0)) AS d, r, t
  FROM checked i JOIN c USING (conv_id) LEFT JOIN lens l ON l.conv_id = i.base WHERE c.pos > i.h
  UNION ALL SELECT i.conv_id, c.pos, r, t FROM checked i JOIN c ON c.conv_id = i.base AND c.pos <= i.h
), paths AS (
  SELECT conv_id, d, length(t) AS size, string_agg(sha256(length(r) || ':' || r || t), '/') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM checked
), ends AS (
  SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(path, d) AS path FROM paths GROUP BY conv_id) GROUP BY path
), nodes AS (
  SELECT path, d, size, min(conv_id) AS conv_id, count(*) AS n, CASE WHEN d = 0 THEN NULL WHEN d = 1 THEN '' ELSE left(path, length(path) - 65) END AS parent
  FROM paths GROUP BY path, d, size
), kids AS (SELECT parent AS path, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), below AS (
  SELECT a.path, count(*) FILTER (k.n IS NULL) AS leaves, sum((b.n - 1) * b.size) AS saved
  FROM nodes a JOIN nodes b ON starts_with(b.path, a.path) LEFT JOIN kids k ON k.path = b.path GROUP BY a.path
)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(k.n, 0) AS n_children, b.leaves AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes v JOIN below b ON b.path = v.path LEFT JOIN nodes p ON p.path = v.parent LEFT JOIN kids k ON k.path = v.path LEFT JOIN ends e ON e.path = v.path
"""

ENTRIES = {
    "op1_byte_bpe": (op1, None),
    "op2_url_filter": (op2, None),
    "op3_ngram_score": (op3, None),
    "op4_embedding_dedup": (op4, OP4_SQL),
    "op5_line_dedup": (op5, None),
    "op6_source_mix": (op6, None),
    "op7_shingle_join": (op7, OP7_SQL),
    "op8_quality_rules": (op8, None),
    "op9_secret_scan": (op9, None),
    "op10_token_files": (op10, None),
    "op11_collocations": (op11, OP11_SQL),
    "op12_prefix_trie": (op12, OP12_SQL),
    "op13_multiset_fingerprint": (op13, None),
}
