"""Quality rule: lines that many documents of one host share.

A line is normalised (lower case, white space collapsed, digit runs as 0) and hashed to 128 bits.
The distinct documents holding it are counted per host; a line in more than `max_docs` documents of
its host is boilerplate and is removed there. A document left with less than `min_kept` of its
characters is rejected. `line_decisions` gives the counts and the keep bits of each document,
`drop_common_lines` the documents that stay, without their common lines.

Defined results
---------------
* A document counts once for a line, however often it repeats it; exactly repeated rows (same id,
  host and text) are one document.
* Blank lines are neither counted nor removed; a document without characters has a kept share of
  1.0 and is kept. Null text counts as no lines. A null host is a host of its own.
* Removing keeps the other lines as they are, blank ones too. Null and blank texts stay as they are.
* A line in exactly max_docs documents stays, a document left with exactly min_kept stays. Long texts are read to their end.
* The empty table gives no rows; other columns are ignored or carried.

Scale: lines are hashed once and written; documents bring each line once, counts combine before the shuffle, and only hashes move.
The lines above the limit are broadcast when their checked number is small; otherwise they join
by a shuffle, where adaptive execution splits hot hosts and lines. Only `drop_common_lines` moves
texts, once, since their decisions come from other partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import BROADCAST_BYTES, cut, table, text_key, written

MAX_DOCS, MIN_KEPT = 20, 0.3


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), "[ \t\r\f\x0b]+", " "))


def _lines(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """A row for each line of each document; the hashes are null for a blank line or a null text."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(host_col).cast("string").alias("host"))
    lines = base.select("id", "host", text_key(F.col("text")).alias("th"), F.posexplode_outer(F.split("text", "\n", -1)).alias("pos", "line"))
    pos, line = F.when(F.col("line").isNotNull(), F.col("pos")), F.nullif(normal_line(F.col("line")), F.lit(""))
    lines = lines.select("id", "host", "th", pos.alias("pos"), line.alias("line"))
    written_line = F.col("line").isNotNull()
    h1, h2 = F.when(written_line, F.xxhash64("line")), F.when(written_line, F.xxhash64(F.lit("line"), "line"))
    return lines.select("id", F.struct("host").alias("host"), "th", "pos", h1.alias("h1"), h2.alias("h2"), F.length("line").alias("size"))


def _decided(docs: DataFrame, id_col: str, text_col: str, host_col: str, max_docs: int, min_kept: float) -> DataFrame:
    """(id, host, th, n, n_lines, n_removed, kept_share, gone): lines of the text (null for a null text), written and removed ones, sorted numbers of those removed."""
    lines = written(_lines(docs, id_col, text_col, host_col), "lines")  # texts are split and normalised once
    counts = lines.filter("h1 IS NOT NULL").select("id", "th", "host", "h1", "h2").distinct().groupBy("host", "h1", "h2").agg(F.count("*").alias("docs"))
    common = cut(counts.filter(F.col("docs") > max_docs).select("host", "h1", "h2", F.lit(1).alias("is_common")))
    if common.count() * 96 <= BROADCAST_BYTES:
        common = F.broadcast(common)
    marked = lines.join(common, ["host", "h1", "h2"], "left")
    gone = F.col("is_common").isNotNull()
    sums = marked.groupBy("id", "host", "th").agg(
        F.count_if(F.coalesce("pos", F.lit(0)) == 0).alias("repeats"), (F.max("pos") + 1).alias("n"), F.count("h1").alias("n_lines"), F.count("is_common").alias("n_removed"),
        F.sum("size").alias("total"), F.sum(F.when(~gone, F.col("size")).otherwise(0)).alias("left"), F.sort_array(F.collect_set(F.when(gone, F.col("pos")))).alias("gone"),
    )
    share = F.when(F.col("total") > 0, F.coalesce("left", F.lit(0)) / F.col("total")).otherwise(F.lit(1.0))
    once = lambda c: (F.col(c) / F.col("repeats")).cast("long").alias(c)
    return sums.select("id", "host", "th", "n", once("n_lines"), once("n_removed"), share.alias("kept_share"), (share >= min_kept).alias("keep"), "gone")


def line_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_docs: int = MAX_DOCS, min_kept: float = MIN_KEPT) -> DataFrame:
    """(doc_id, host, n_lines, n_removed, kept_share, keep, line_bits) of each document.

    line_bits has a character a line, 1 where the line stays and 0 where it is removed; null for a null text.
    """
    decided = _decided(docs, id_col, text_col, host_col, max_docs, min_kept)
    # between two removed lines a run of 1s
    ends = F.concat("gone", F.array("n"))
    runs = F.transform(ends, lambda p, k: F.repeat(F.lit("1"), (p - F.when(k > 0, F.get(F.col("gone"), k - 1) + 1).otherwise(0)).cast("int")))
    bits = F.when(F.col("n").isNotNull(), F.array_join(runs, "0"))
    return decided.select(F.col("id").alias(id_col), F.col("host.host").alias("host"), "n_lines", "n_removed", "kept_share", "keep", bits.alias("line_bits"))


def drop_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", length_col: str | None = "n_chars", max_docs: int = MAX_DOCS, min_kept: float = MIN_KEPT) -> DataFrame:
    """The documents that are not depleted, without the lines above the limit; their other columns as they were.

    length_col, where present, becomes the new length. Repeated rows stay repeated.
    """
    decided = _decided(docs, id_col, text_col, host_col, max_docs, min_kept).filter("keep").select(F.struct("id", "host", "th").alias("_key"), F.col("n").alias("_n"), F.col("gone").alias("_gone"))
    key = F.struct(F.col(id_col).alias("id"), F.struct(F.col(host_col).cast("string").alias("host")).alias("host"), text_key(F.col(text_col)).alias("th"))
    rows = docs.select(key.alias("_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    text = F.col("_row").getField(text_col)
    stay = F.array_except(F.sequence(F.lit(0), F.col("_n") - 1), F.col("_gone"))
    # the lines are bound to a variable: a lambda would split the text again for each of them
    left = F.get(F.transform(F.array(F.split(text, "\n", -1)), lambda lines: F.array_join(F.transform(stay, lambda p: F.get(lines, p)), "\n")), F.lit(0))
    joined = rows.join(decided.hint("shuffle_hash"), "_key").select("_row", F.when(F.size("_gone") == 0, text).otherwise(left).alias("_text"))
    new_length = lambda c: c == length_col and docs.schema[c].dataType.typeName() in ("long", "integer")
    return joined.select(*[
        F.col("_text").alias(c) if c == text_col else F.length("_text").cast(docs.schema[c].dataType).alias(c) if new_length(c) else F.col("_row").getField(c).alias(c) for c in docs.columns
    ])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_decisions(table(spark, sf_dir, "documents"))


def op9_clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the rule leaves, without boilerplate."""
    return drop_common_lines(table(spark, sf_dir, "documents"))


_SQL = rf"""
WITH lines AS (
  SELECT doc_id, host, raw, pos, nullif(trim(regexp_replace(regexp_replace(lower(raw), '[0-9]+', '0', 'g'), '[ \t\r\f\v]+', ' ', 'g'), ' '), '') AS line
  FROM (SELECT doc_id, source AS host, unnest(parts) AS raw, unnest(range(len(parts))) AS pos FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents))
), common AS (
  SELECT host, line FROM lines WHERE line IS NOT NULL GROUP BY host, line HAVING count(DISTINCT doc_id) > {MAX_DOCS}
), marked AS (
  SELECT l.doc_id, pos, raw, l.line, c.line IS NOT NULL AS gone FROM lines l LEFT JOIN common c ON l.line = c.line AND l.host IS NOT DISTINCT FROM c.host
), sums AS (
  SELECT doc_id, count(line) AS n_lines, count_if(gone) AS n_removed, string_agg(CASE WHEN gone THEN '0' ELSE '1' END, '' ORDER BY pos) AS line_bits,
         coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text_left,
         coalesce(sum(CASE WHEN NOT gone THEN length(line) END)::DOUBLE / nullif(sum(length(line)), 0)::DOUBLE, CASE WHEN count(line) > 0 THEN 0 ELSE 1 END) AS kept_share
  FROM marked GROUP BY doc_id
)
"""
SQL = rf"""{_SQL}
SELECT d.doc_id, d.source AS host, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(kept_share, 1.0)::DOUBLE AS kept_share, coalesce(kept_share, 1.0) >= {MIN_KEPT} AS keep, line_bits
FROM documents d LEFT JOIN sums USING (doc_id)
"""
CLEAN_SQL = rf"""{_SQL}
SELECT d.doc_id, CASE WHEN n_removed > 0 THEN text_left ELSE text END AS text, lang, source,
       length(CASE WHEN n_removed > 0 THEN text_left ELSE text END)::BIGINT AS n_chars
FROM documents d LEFT JOIN sums USING (doc_id) WHERE coalesce(kept_share, 1.0) >= {MIN_KEPT}
"""

QUERIES = {"op9_quality_rules": op9_quality_rules, "op9_clean_documents": op9_clean_documents}
ORACLE = {"op9_quality_rules": SQL, "op9_clean_documents": CLEAN_SQL}
