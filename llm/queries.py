"""Queries that apply each operator to its whole table, and checking SQL where SQL can express the operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from llm import (
    alignment, bpe, decontaminate, language, manifest, mixing, ngram_join, pii, quotes, sharding, substrings, syncmers, token_files,
)
from llm.common import read

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip_report(read(spark, folder, "documents"), VOCABULARY)


@_query
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.span_report(read(spark, folder, "documents"))


@_query
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination_report(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@_query
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_report(read(spark, folder, "documents"), 40)


@_query
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.file_report(read(spark, folder, "documents"), VOCABULARY)


@_query
def op6_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.class_report(read(spark, folder, "documents"))


@_query
def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_report(read(spark, folder, "documents"))


@_query
def op8_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeat_report(read(spark, folder, "documents"))


@_query
def op9_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.fingerprint_report(read(spark, folder, "documents"))


@_query
def op10_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.conversation_report(read(spark, folder, "conversations"))


@_query
def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(read(spark, folder, "documents"))


@_query
def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment_report(read(spark, folder, "documents"), BYTES, PIECES)


@_query
def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.manifest_report(read(spark, folder, "documents"))


_WORDS_AZ09 = (
    r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SQL["op3_decontamination"] = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS_AZ09.format('text')}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS_AZ09.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT item_id, len(w) AS n, array_to_string(w[i:i + 9], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT least(n, 10) AS n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = least(bw.n, 10)),
words_hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(words_hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(items.names, '')) AS items_sha256, coalesce(words_hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
SQL["op8_substrings"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
win AS (
  SELECT r, i, md5_number(array_to_string(w[i:i + 34], ' ')) AS k
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
twice AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM win SEMI JOIN twice USING (k)),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

SQL["op6_ngram_join"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, md5_number(array_to_string(w[i:i + 2], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
rare AS (SELECT s FROM sh GROUP BY s HAVING count(*) > 1),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM (SELECT * FROM sh SEMI JOIN rare USING (s)) x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 90 * (na.n + nb.n - c)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a) m USING (doc_id)
"""

SQL["op11_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS lot
  FROM documents),
s AS (
  SELECT source, sum(size) AS n, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
o AS (
  SELECT *, (sum(n) OVER () - coalesce(sum(3 * n) OVER below, 0)) / CAST(sum(w) OVER () - coalesce(sum(w) OVER below, 0) AS DOUBLE) AS level
  FROM s WINDOW below AS (ORDER BY 3 * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT max(level) AS level FROM o),
t AS (SELECT source, CAST(n AS BIGINT) AS n, CASE WHEN 3 * n < level * w THEN CAST(3 * n AS DOUBLE) ELSE level * w END AS target FROM s, l),
r AS (
  SELECT d.doc_id, d.size, t.n, t.target, CASE WHEN t.n > 0 THEN least(floor(t.target / t.n), 3) ELSE 0 END AS rounds,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.lot ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, n AS source_size, target,
  CAST(size * (rounds + CASE WHEN size > 0 AND 2 * (target - rounds * n - before) >= size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""


def _field(column: str, value: str | None = None) -> str:
    value = value or column
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


_LEAF = "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars"])) + " || {})"
_CRC32 = """list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT for x in string_split(CAST(doc_id AS VARCHAR), '')]),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, k: xor(x >> 1, (x & 1) * 3988292384)))"""
SQL["op13_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, {_LEAF.format(_field('text'))} AS leaf,
    CASE WHEN xor({_CRC32}, 4294967295) % 2 = 0 THEN {_LEAF.format(_field('text', "replace(text, chr(10), '')"))}
    ELSE {_LEAF.format(_field('text'))} END AS claimed
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i, count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t
  FROM d),
low AS (
  SELECT 0 AS l, t, i, n, leaf AS h FROM placed
  UNION ALL
  SELECT l + 1, t, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY l, t, i // 3, n),
high AS (
  SELECT 0 AS l, t AS i, (SELECT count(DISTINCT t) FROM placed) AS n, h FROM low WHERE n = 1
  UNION ALL
  SELECT l + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY l, i // 3, n),
runs AS (
  SELECT l, t, i // 3 AS p, n, list(h ORDER BY i) AS hs FROM low GROUP BY l, t, i // 3, n
  UNION ALL
  SELECT l, -1, i // 3, n, list(h ORDER BY i) FROM high GROUP BY l, i // 3, n),
walk AS (
  SELECT r, 0 AS l, t, i, n, t AS own, claimed AS h, '' AS proof FROM placed
  UNION ALL
  SELECT w.r, CASE WHEN w.n = 1 THEN 0 ELSE w.l + 1 END, CASE WHEN w.n = 1 THEN -1 ELSE w.t END,
    CASE WHEN w.n = 1 THEN w.own ELSE w.i // 3 END, CASE WHEN w.n = 1 THEN (SELECT count(DISTINCT t) FROM placed) ELSE (w.n + 2) // 3 END, w.own,
    CASE WHEN w.n = 1 THEN w.h ELSE sha256(list_aggregate(list_concat(hs[:w.i % 3], [w.h], hs[w.i % 3 + 2:]), 'string_agg', '')) END,
    CASE WHEN w.n = 1 THEN w.proof
    ELSE w.proof || coalesce(list_aggregate(list_concat(hs[:w.i % 3], hs[w.i % 3 + 2:]), 'string_agg', ''), '') END
  FROM walk w JOIN runs ON runs.l = w.l AND runs.t = w.t AND runs.p = w.i // 3 AND (w.n > 1 OR w.t >= 0)),
ends AS (SELECT r, h, proof FROM walk WHERE t = -1 AND n = 1),
subroots AS (SELECT t, h FROM low WHERE n = 1),
root AS (SELECT h FROM high WHERE n = 1)
SELECT placed.doc_id, placed.leaf, subroots.h AS subroot, root.h AS root, sha256(ends.proof) AS proof_sha256, ends.h AS folded_root,
  ends.h = root.h AS verified
FROM placed JOIN ends USING (r) JOIN subroots USING (t), root
"""
