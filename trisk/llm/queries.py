"""The registered queries of this package over the test tables, and their SQL.

Every query applies its operator with production parameters to its whole table and
returns the whole result. ``ORACLES`` has DuckDB SQL where SQL can express the result;
the tests in tests/llm hold the others against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trisk.llm import (class_lm, decontaminate, license_rules, line_templates, merkle, mixing, periodic_runs,
                       quality_forest, simhash, style_tree, suffix_dedup, token_files, token_spans)
from trisk.llm.store import ship, work_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_extract_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return style_tree.extract(_table(spark, sf_dir, "pages"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-ID files of ``documents``: written as ORC, read back, one digest row per document."""
    return token_files.token_files(_table(spark, sf_dir, "documents"), work_path(spark, "token-files"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of ``benchmark`` windows in every document."""
    return decontaminate.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, encoded as a whole."""
    return token_spans.line_token_counts(_table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    return license_rules.scan(_table(spark, sf_dir, "documents"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    documents, pieces = mixing.mix(_table(spark, sf_dir, "documents"))
    return (mixing.taken_words(documents, pieces)
            .select("doc_id", "size", "source_size", "target", "taken", "source"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeated 400-byte strings cover."""
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every document; the forest is fitted on ``labels``."""
    docs = _table(spark, sf_dir, "documents")
    return quality_forest.judge(docs, quality_forest.fit(docs, _table(spark, sf_dir, "labels")))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of recurring templates, as a digest."""
    found = line_templates.drop_lines(_table(spark, sf_dir, "documents"), long_docs=line_templates.LONG_DOCS)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def _with_planted_periods(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by CRC-32 of the id, continues from word a with period p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", F.floor(h / 10).alias("g"),
                        F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
                        .alias("words"))
    n = F.size("words")
    sized = words.select("*", F.when(n > 0, n).alias("n"))
    placed = sized.select("*", (F.col("g") % F.col("n")).cast("int").alias("a"))
    placed = placed.select("*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int").alias("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), F.col("n") - F.col("a")))
    return placed.select("doc_id", F.coalesce(F.array_join(planted, " "), "text").alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words, a tenth of the documents with a planted period."""
    found = periodic_runs.find_runs(_with_planted_periods(_table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of ``documents``; in a third of them, by CRC-32 of the id, the text folded in
    has its A-Z lower-cased."""
    docs = _table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.manifest(docs, F.when(tampered, lowered).otherwise(F.col("text")))


def op13_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a class bigram model learned from six sevenths of them."""
    return class_lm.score(_table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(text) AS hash
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][(r % 3 + 1)::INT] AS w, 3 * source_size AS top FROM sources),
filled AS (
  SELECT *, top::DOUBLE / w AS ratio,
    (sum(source_size) OVER () - coalesce(sum(top) OVER (ORDER BY top::DOUBLE / w, r
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY top::DOUBLE / w, r
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighted),
targets AS (
  SELECT source, source_size, r, least(top::DOUBLE, coalesce(
    (SELECT arg_min(level, (ratio, r)) FROM filled WHERE level <= ratio) * w, top::DOUBLE)) AS target
  FROM filled),
lined AS (
  SELECT d.*, s.source_size, s.target, floor(s.target + 0.5)::BIGINT AS upto,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(hash, ''))
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized d JOIN targets s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target, source,
  (greatest(least(upto, start + size) - start, 0)
   + greatest(least(upto, source_size + start + size) - source_size - start, 0)
   + greatest(least(upto, 2 * source_size + start + size) - 2 * source_size - start, 0))::BIGINT AS taken
FROM lined
"""

OP12_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS t
  FROM range(256) r(i)),
fields AS (
  SELECT doc_id, lang, text, CASE WHEN doc_id IS NOT NULL THEN xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 3 = 0 ELSE false END AS tampered,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM documents, crc_table),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text) || ':' || CASE WHEN tampered
      THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS other
  FROM fields),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS r FROM leaves),
tree(lang, lvl, pos, n, digest) AS (
  SELECT lang, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT lang, any_value(lvl) + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM tree WHERE n > 1 GROUP BY lang, pos // 8),
subroots AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM tree WHERE n = 1),
over_tree(lvl, pos, n, digest) AS (
  SELECT 0, pos, n, subroot FROM subroots
  UNION ALL
  SELECT any_value(lvl) + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM over_tree WHERE n > 1 GROUP BY pos // 8),
nodes AS (
  SELECT coalesce('=' || lang, '') AS grp, lvl, pos, n, digest FROM tree
  UNION ALL SELECT '/', lvl, pos, n, digest FROM over_tree),
walk(r, grp, lvl, pos, n, proof, folded) AS (
  SELECT r, coalesce('=' || lang, ''), 0, pos, n, '', other FROM placed
  UNION ALL
  SELECT w.r, any_value(w.grp), any_value(w.lvl) + 1, any_value(w.pos) // 8, (any_value(w.n) + 7) // 8,
    any_value(w.proof) || coalesce(string_agg(k.digest, '' ORDER BY k.pos) FILTER (k.pos <> w.pos), ''),
    sha256(string_agg(CASE WHEN k.pos = w.pos THEN w.folded ELSE k.digest END, '' ORDER BY k.pos))
  FROM walk w JOIN nodes k ON k.grp = w.grp AND k.lvl = w.lvl AND k.pos // 8 = w.pos // 8
  WHERE w.n > 1 GROUP BY w.r),
half AS (
  SELECT w.r, w.proof, w.folded, s.pos, s.n, s.subroot, p.doc_id, p.leaf
  FROM walk w JOIN placed p USING (r) JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang WHERE w.n = 1),
over_walk(r, lvl, pos, n, proof, folded) AS (
  SELECT r, 0, pos, n, proof, folded FROM half
  UNION ALL
  SELECT w.r, any_value(w.lvl) + 1, any_value(w.pos) // 8, (any_value(w.n) + 7) // 8,
    any_value(w.proof) || coalesce(string_agg(k.digest, '' ORDER BY k.pos) FILTER (k.pos <> w.pos), ''),
    sha256(string_agg(CASE WHEN k.pos = w.pos THEN w.folded ELSE k.digest END, '' ORDER BY k.pos))
  FROM over_walk w JOIN nodes k ON k.grp = '/' AND k.lvl = w.lvl AND k.pos // 8 = w.pos // 8
  WHERE w.n > 1 GROUP BY w.r),
root AS (SELECT digest AS root FROM over_tree WHERE n = 1)
SELECT h.doc_id, h.leaf, h.subroot, root.root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root,
  w.folded = root.root AS verified
FROM half h JOIN over_walk w ON w.r = h.r AND w.n = 1, root
"""

QUERIES: dict[str, Query] = {
    "op1_extract_html": op1_extract_html,
    "op2_token_files": op2_token_files,
    "op3_decontaminate": op3_decontaminate,
    "op4_token_counts": op4_token_counts,
    "op5_license_scan": op5_license_scan,
    "op6_mix_sources": op6_mix_sources,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_simhash": op9_simhash,
    "op10_line_templates": op10_line_templates,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_class_lm": op13_class_lm,
}

ORACLES: dict[str, str] = {"op6_mix_sources": OP6_SQL, "op12_merkle_manifest": OP12_SQL}
