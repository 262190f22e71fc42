"""Registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airway.llm.decontamination import find_benchmark, hit_words
from airway.llm.digest_merge import exact_duplicates
from airway.llm.html_extraction import extract_main_text
from airway.llm.license_scan import find_licenses
from airway.llm.merkle_manifest import folded, leaf_hash, merkle_manifest, proof_text, shown
from airway.llm.mixing import mix_sources
from airway.llm.near_dedup import near_duplicates
from airway.llm.paragraph_dedup import repeated_paragraphs
from airway.llm.passage_dedup import repeated_passages
from airway.llm.quality_model import score_quality
from airway.llm.quality_rules import judge_quality
from airway.llm.secret_scan import find_secrets
from airway.llm.spelling_variants import spelling_variants
from airway.llm.token_counts import count_tokens


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k sketches, inverted lists, exact Jaccard: one row per document."""
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("size").alias("n_shingles"),
        F.col("root").alias("component_id"),
        F.coalesce(F.col("id") == F.col("root"), F.lit(True)).alias("kept"),
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs named licence notices, with their family."""
    return find_licenses(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poisson replication to the target shares: every copy of every document."""
    return mix_sources(_table(spark, sf_dir, "documents"))


def op4_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factorisation machine fitted on rows that are not held out, over all documents."""
    found = score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), "held_out", "score", "predicted")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern and entropy spans of every text, with a digest of the pattern spans."""
    found = find_secrets(_table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"),
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] != "entropy")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count("entropy"),
    )


def op6_repeated_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs that repeat, in one document or several."""
    found = repeated_paragraphs(_table(spark, sf_dir, "documents"))
    return found.withColumnsRenamed({"id": "doc_id", "start": "start_at", "end": "end_at", "first_id": "first_doc_id"})


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that repeat, exactly or nearly, wherever lines begin and end."""
    found = repeated_passages(_table(spark, sf_dir, "documents"))
    return found.withColumnsRenamed({"id": "doc_id", "start": "start_at", "end": "end_at", "first_id": "first_doc_id"})


def op7_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wu-Manber search for all benchmark windows in all documents."""
    found = find_benchmark(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages, site templates removed."""
    return extract_main_text(_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the unigram scores of a public vocabulary."""
    return count_tokens(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted limits and Jensen-Shannon distances to the references of the languages."""
    return judge_quality(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted digest runs merged along a tree: of equal texts the largest doc_id stays."""
    found = exact_duplicates(_table(spark, sf_dir, "documents"), keep="largest")
    return found.withColumnsRenamed({"id": "doc_id", "n": "group_size", "sha": "text_sha256"})


# Fixed values of the contract: what a leaf hashes, and whose n_chars are altered.
_LEAF = ["doc_id", "source", "lang", "n_chars", "text"]
_TAMPERED_EVERY = 7


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents, each checked against the root by its proof."""
    docs = _table(spark, sf_dir, "documents")
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % _TAMPERED_EVERY == 0
    seen = leaf_hash(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in _LEAF])
    found = merkle_manifest(docs, _LEAF, carry={"seen": F.when(altered, seen)})
    fold = folded(F.coalesce("seen", "leaf"), F.col("path"))
    rows = found.select("*", fold.alias("folded_root"), shown(F.col("root")).alias("root_text"))
    return rows.select(
        F.col("id").alias("doc_id"),
        shown(F.col("leaf")).alias("leaf"),
        shown(F.col("subroot")).alias("subroot"),
        F.col("root_text").alias("root"),
        F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root_text")).alias("verified"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, their near words and the forms that they are variants of."""
    return spelling_variants(_table(spark, sf_dir, "documents"))


# Words of a text as SQL lists: lower-cased A-Z, cut at ASCII white space.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_OP1_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_SPACE_WORDS.format(_LOWER)} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""

_OP3_SQL = """
WITH RECURSIVE sizes AS (
  SELECT source, sum(coalesce(length(text), 0))::BIGINT AS chars FROM documents GROUP BY source),
shares AS (
  SELECT source, CASE WHEN chars > 0 THEN sqrt(chars) / sum(sqrt(chars)) OVER () * (sum(chars) OVER ())::DOUBLE / chars
    ELSE 0 END AS rate FROM sizes),
means AS (
  SELECT source, floor(rate / 16)::INT AS parts, rate - floor(rate / 16)::INT * 16 AS mean FROM shares
  UNION ALL SELECT '#full', 0, 16.0),
steps AS (
  SELECT source, 0 AS k, mean, exp(-mean) AS p, exp(-mean) AS cdf FROM means
  UNION ALL
  SELECT source, k + 1, mean, p * mean / (k + 1), cdf + p * mean / (k + 1) FROM steps WHERE k < 80),
tables AS (SELECT source, list(cdf ORDER BY k) AS cdf FROM steps GROUP BY source),
keyed AS (
  SELECT d.*, m.parts, t.cdf, f.cdf AS full_cdf, coalesce(d.doc_id::VARCHAR, md5(d.text), '') AS key
  FROM documents d JOIN means m ON d.source IS NOT DISTINCT FROM m.source
  JOIN tables t ON d.source IS NOT DISTINCT FROM t.source JOIN tables f ON f.source = '#full'),
counted AS (
  SELECT *, len(list_filter(cdf, lambda c: c <= ('0x' || substr(md5('mix-1|0|' || key), 1, 13))::BIGINT / 4503599627370496.0))
    + coalesce(list_sum(list_transform(range(1, parts + 1), lambda i: len(list_filter(full_cdf,
        lambda c: c <= ('0x' || substr(md5('mix-1|' || i || '|' || key), 1, 13))::BIGINT / 4503599627370496.0)))), 0) AS n
  FROM keyed),
copies AS (
  SELECT doc_id, text, lang, source, n_chars, key, unnest(range(1, n::INT + 1))::INT AS copy FROM counted)
SELECT doc_id, text, lang, source, n_chars, copy,
  ('0x' || substr(md5('mix-1|order|' || copy || '|' || key), 1, 13))::BIGINT / 4503599627370496.0 AS place
FROM copies
"""

_OP6_SQL = f"""
WITH RECURSIVE lines AS (
  SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)),
paragraphs AS (
  SELECT doc_id, i - 1 AS paragraph, length(lines[i]) AS n, coalesce(list_sum(list_transform(lines[1:i - 1], lambda x: length(x) + 1)), 0) AS start_at,
    {_SPACE_WORDS.format(_LOWER.replace("text", "lines[i]"))} AS w
  FROM lines),
long AS (SELECT *, row_number() OVER (ORDER BY doc_id, paragraph) AS id FROM paragraphs WHERE len(w) >= 25),
shingles AS (
  SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT id, w, unnest(range(1, len(w) - 3)) AS i FROM long)),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
shared AS (
  SELECT a.id AS a, b.id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.id <> b.id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b
  WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
reach AS (
  SELECT id, id AS r FROM long UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.r = links.a),
firsts AS (SELECT id, min(r) AS first, count(*) AS n FROM reach GROUP BY id)
SELECT p.doc_id, p.paragraph::INT AS paragraph, p.start_at::BIGINT AS start_at, (p.start_at + p.n)::BIGINT AS end_at,
  f.doc_id AS first_doc_id, f.paragraph::INT AS first_paragraph, p.id <> f.id AS removed
FROM long p JOIN firsts ON firsts.id = p.id AND firsts.n > 1 JOIN long f ON f.id = firsts.first
"""

_OP7_SQL = f"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
    SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
    FROM item_words WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT doc_id, item_id, p.n, i FROM places p JOIN windows x ON p.n = x.n AND p.s = x.s),
hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP11_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# CRC-32 by its table, over the bytes of a text.
_CRC_TABLE = """
crc AS (
  SELECT list(list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT) ORDER BY i) AS t
  FROM range(256) r(i))"""
_CRC = """xor(list_reduce(list_transform(range(1, strlen({0}) + 1), lambda i: ('0x' || substr(hex(encode({0})), 2 * i - 1, 2))::BIGINT),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295)"""


def _leaf_sql(n_chars: str) -> str:
    parts = [c if c != "n_chars" else n_chars for c in _LEAF]
    return "sha256(" + " || ".join(f"coalesce(strlen(({p})::VARCHAR) || ':' || ({p})::VARCHAR, '-')" for p in parts) + ")"


_OP12_SQL = f"""
WITH RECURSIVE {_CRC_TABLE},
rows AS (
  SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
    CASE WHEN {_CRC.format("doc_id::VARCHAR")} % {_TAMPERED_EVERY} = 0 THEN {_leaf_sql("n_chars + 1")} END AS altered
  FROM documents, crc),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM rows),
nodes AS (
  SELECT 0 AS level, lang, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT level + 1, lang, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY level, lang, pos // 2, n),
subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos, n, h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 2, n),
steps AS (
  SELECT d.doc_id, d.leaf, d.pos, d.lang, m.level AS k, m.pos AS own, s.pos AS other, coalesce(s.h, '') AS h
  FROM leaves d JOIN nodes m ON m.lang IS NOT DISTINCT FROM d.lang AND m.n > 1 AND m.pos = d.pos >> m.level
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM m.lang AND s.level = m.level AND s.pos // 2 = m.pos // 2 AND s.pos <> m.pos
  UNION ALL
  SELECT d.doc_id, d.leaf, d.pos, d.lang, 1000 + m.level, m.pos, s.pos, coalesce(s.h, '')
  FROM leaves d JOIN subroots r ON r.lang IS NOT DISTINCT FROM d.lang JOIN tops m ON m.n > 1 AND m.pos = r.pos >> m.level
  LEFT JOIN tops s ON s.level = m.level AND s.pos // 2 = m.pos // 2 AND s.pos <> m.pos),
paths AS (
  SELECT lang, pos, string_agg(h, '' ORDER BY k) AS proof, list(CASE WHEN other < own THEN h || '|' ELSE '|' || h END ORDER BY k) AS path
  FROM steps GROUP BY lang, pos),
found AS (
  SELECT d.doc_id, d.leaf, r.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
    list_reduce(coalesce(p.path, []), lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2)), coalesce(d.altered, d.leaf)) AS folded_root
  FROM leaves d JOIN subroots r ON r.lang IS NOT DISTINCT FROM d.lang
  LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM d.lang AND p.pos = d.pos)
SELECT *, folded_root = root AS verified FROM found
"""

_OP13_SQL = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents),
hashed AS (
  SELECT run, {_CRC.format("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM runs, crc WHERE length(run) >= 6),
words AS (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
skips AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (
    SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
pairs AS (
  SELECT x.word AS u, y.word AS v FROM skips x JOIN skips y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word FROM skips x JOIN words y ON y.word = x.a || x.b
  UNION SELECT y.word, x.word FROM skips x JOIN words y ON y.word = x.a || x.b),
best AS (
  SELECT u, count(*) AS n_near, arg_min(v, (-w.n, v)) AS v, max(w.n) AS form_n FROM pairs JOIN words w ON w.word = v GROUP BY u),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN v END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best ON u = word),
chains AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n
FROM forms f JOIN chains c ON c.word = f.word JOIN forms e ON e.word = c.at AND e.form IS NULL
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_duplicates,
        op2_licenses,
        op3_source_mixture,
        op4_quality_scores,
        op5_secrets,
        op6_repeated_passages,
        op6_repeated_paragraphs,
        op7_benchmark_hits,
        op8_main_text,
        op9_token_counts,
        op10_quality_rules,
        op11_exact_dedup,
        op12_merkle_manifest,
        op13_spelling_variants,
    )
}
SQL: dict[str, str] = {
    "op1_near_duplicates": _OP1_SQL,
    "op3_source_mixture": _OP3_SQL,
    "op6_repeated_paragraphs": _OP6_SQL,
    "op7_benchmark_hits": _OP7_SQL,
    "op11_exact_dedup": _OP11_SQL,
    "op12_merkle_manifest": _OP12_SQL,
    "op13_spelling_variants": _OP13_SQL,
}
