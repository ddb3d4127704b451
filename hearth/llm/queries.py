"""The thin registered queries of the training-data operators, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import (balltree, cotrain, exact_dedup, filter_audit, host_rules, html_extract, license_scan, merkle, minhash,
                        mixing, packing, secrets, suffix_dedup)
from hearth.llm.common import table

#: Folder of the public tokenizer files (a parameter: the files are never copied).
TOKENIZERS = "/opt/tokenizers"
TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path(folder: str = TOKENIZERS, name: str = TOKENIZER_FILE) -> str:
    """The file's place as its own package gives it, or below ``folder``."""
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return f"{folder}/{name}"
    return public_tokenizers.path(name)


def op1_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a tree of files: source/lang/doc_id."""
    docs = table(spark, sf_dir, "documents")
    return license_scan.scan(docs.select("doc_id", F.concat_ws("/", "source", "lang", "doc_id").alias("path"), "text"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op4_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = balltree.written(balltree.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "ball-vectors")
    return balltree.top_k(vectors, vectors.filter("id % 50 = 0"), k=5)


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_plan(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.audit(table(spark, sf_dir, "documents"))


def op12_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.newlines_removed())


QUERIES = {f.__name__: f for f in vars(sys.modules[__name__]).copy().values()
           if callable(f) and getattr(f, "__name__", "").startswith("op")}

ORACLE_SQL: dict[str, str] = {}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE_SQL["op9_source_mixing"] = rf"""
WITH sized AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
src AS (
  SELECT source, sum(size)::DOUBLE AS s, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1)::BIGINT % 3 + 1]::DOUBLE AS w
  FROM sized GROUP BY source),
-- sources by the level at which they are full; the level that the others share if all before them are full
filled AS (
  SELECT *, 3.0 * s / w AS full_at,
         (sum(s) OVER () - coalesce(sum(3.0 * s) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level,
         row_number() OVER (ORDER BY 3.0 * s / w, source) AS k
  FROM src WINDOW o AS (ORDER BY 3.0 * s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (SELECT coalesce(arg_min(level, k) FILTER (w * level < 3.0 * s), max(full_at)) AS level FROM filled),
target AS (
  SELECT source, source_size, s, CASE WHEN s > 0 THEN least(w * f.level, 3.0 * s) ELSE 0.0 END::DOUBLE AS target
  FROM src, final f),
rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.s > 0 THEN t.target / t.s ELSE 0.0 END AS rate,
         ('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::UBIGINT::DOUBLE / 1152921504606846976.0 AS u
  FROM sized d JOIN target t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""

ORACLE_SQL["op5_host_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (
  SELECT rid, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS k
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
hit AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM g) WHERE c > 1),
covered AS (
  SELECT rid, sum(least(5, coalesce(i - before, 5)))::BIGINT AS n
  FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM hit) GROUP BY rid),
f AS (
  SELECT d.rid, doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered c USING (rid)),
j AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines AS mild FROM f),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS failed FROM j GROUP BY source),
m AS (SELECT avg(failed / n) AS m, greatest(var_pop(failed / n) - avg((failed / n) * (1 - failed / n) / n), 1e-6) AS b FROM h),
p AS (SELECT m.m AS m, least(greatest(m.m * (1 - m.m) / m.b - 1, 1.0), 1e4) AS k FROM m),
r AS (SELECT source, (failed + p.m * p.k) / (n + p.k) AS rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR rate >= 0.9 OR (rate >= 0.5 AND mild)) AS kept
FROM j JOIN r ON j.source IS NOT DISTINCT FROM r.source
"""

ORACLE_SQL["op11_digest_index"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, row_number() OVER () AS r,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST, r)
"""

ORACLE_SQL["op12_posting_lists"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT sha256(t) AS h, min(doc_id) AS least FROM t GROUP BY 1),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
f AS (
  SELECT part, (len(w) < 50)::INT AS a, (100 * len(list_distinct(w)) < 65 * len(w))::INT AS b,
         (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT AS c,
         regexp_matches(t, '[#$%&*|]')::INT AS d, coalesce(t.doc_id > m.least, false)::INT AS e,
         coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM t JOIN m ON sha256(t.t) = m.h LEFT JOIN l USING (doc_id)),
-- rows by part and the exact set of filters they fail
g AS (SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
parts AS (SELECT DISTINCT part FROM f),
letters AS (SELECT unnest(['A','B','C','D','E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT p.x || q.x || r.x || s.x || u.x AS filter_order, [p.bit, q.bit, r.bit, s.bit, u.bit] AS bits
  FROM letters p, letters q, letters r, letters s, letters u
  WHERE p.bit | q.bit | r.bit | s.bit | u.bit = 31),
steps AS (
  SELECT filter_order, step, bits[step]::INT AS bit, list_sum(bits[:step])::INT - bits[step]::INT AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
c AS (
  SELECT p.part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS toxic_lost
  FROM parts p CROSS JOIN steps LEFT JOIN g ON g.part = p.part GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM c
"""

ORACLE_SQL["op13_merkle_manifest"] = r"""
WITH RECURSIVE
d AS (
  SELECT doc_id, coalesce('+' || source, '') AS g, text,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM documents),
leafs AS (
  SELECT doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h, head, text FROM d),
-- CRC-32 of the id, bit by bit
crc AS (
  SELECT doc_id AS k, doc_id::VARCHAR AS s, 1 AS place, 4294967295::UBIGINT AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT k, s, place + 1, list_reduce(list_prepend(xor(c, ascii(s[place])::UBIGINT), [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[]),
           lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)
  FROM crc WHERE place <= length(s)),
even AS (SELECT k FROM crc WHERE place = length(s) + 1 AND xor(c, 4294967295::UBIGINT) % 2 = 0),
placed AS (
  SELECT l.doc_id, g, h, row_number() OVER (PARTITION BY g ORDER BY l.doc_id NULLS FIRST, h) - 1 AS i,
         CASE WHEN e.k IS NOT NULL AND text IS NOT NULL
              THEN sha256(head || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '')) ELSE h END AS start
  FROM leafs l LEFT JOIN even e ON e.k = l.doc_id),
t AS (
  SELECT 0 AS l, g, i, h FROM placed
  UNION ALL
  SELECT l + 1, g, i // 3, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM t)
  WHERE c > 1 GROUP BY l, g, i // 3),
subroots AS (SELECT g, arg_max(h, l) AS h FROM t GROUP BY g),
top AS (
  SELECT 0 AS l, row_number() OVER (ORDER BY encode(g)) - 1 AS i, h FROM subroots
  UNION ALL
  SELECT l + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS c FROM top) WHERE c > 1 GROUP BY l, i // 3),
runs AS (SELECT l, g, i // 3 AS r, list(h ORDER BY i) AS hs FROM (SELECT *, count(*) OVER (PARTITION BY l, g) AS c FROM t) WHERE c > 1 GROUP BY ALL),
top_runs AS (SELECT l, i // 3 AS r, list(h ORDER BY i) AS hs FROM (SELECT *, count(*) OVER (PARTITION BY l) AS c FROM top) WHERE c > 1 GROUP BY ALL),
fold AS (
  SELECT doc_id, g, h AS leaf, i AS place, 0 AS l, i, start AS f, '' AS proof FROM placed
  UNION ALL
  SELECT doc_id, g, leaf, place, l + 1, i // 3, sha256(array_to_string(hs[:i % 3], '') || f || array_to_string(hs[i % 3 + 2:], '')),
         proof || array_to_string(hs[:i % 3], '') || array_to_string(hs[i % 3 + 2:], '')
  FROM fold JOIN runs USING (l, g) WHERE r = i // 3),
sub AS (SELECT DISTINCT ON (g, place) * FROM fold ORDER BY g, place, l DESC),
top_fold AS (
  SELECT doc_id, g, leaf, place, 0 AS l, s.i, f, proof, subroot
  FROM (SELECT sub.* EXCLUDE (i, l), h AS subroot, dense_rank() OVER (ORDER BY encode(g)) - 1 AS i FROM sub JOIN subroots USING (g)) s
  UNION ALL
  SELECT doc_id, g, leaf, place, l + 1, i // 3, sha256(array_to_string(hs[:i % 3], '') || f || array_to_string(hs[i % 3 + 2:], '')),
         proof || array_to_string(hs[:i % 3], '') || array_to_string(hs[i % 3 + 2:], ''), subroot
  FROM top_fold JOIN top_runs USING (l) WHERE r = i // 3),
done AS (SELECT DISTINCT ON (g, place) * FROM top_fold ORDER BY g, place, l DESC)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM done, (SELECT arg_max(h, l) AS root FROM top)
"""
