"""Line dedup: which lines of each document appeared earlier in the corpus.

Lines are hashed to 128 bits, range-partitioned on the hash and sorted by hash, document and
position; one streaming pass over each range keeps the first occurrence. Only hashes and positions
move. The answer is one run-length-compressed keep bitmap a document, never text.

Defined results
---------------
* Order of occurrence is (id, text hash, line number), null ids first.
* A line that is blank (empty or white space) is layout and is always kept.
* Null text: null bitmap, zero lines. Empty text: one blank line, kept.
* Rows repeated exactly (same id, same text) are one document and give one row; rows that share an
  id but not a text are separate documents. drop_repeated_lines keeps one of the repeated rows, the first by a hash of all columns.
* The empty table gives no rows. Long texts are read to their end; their lines move as hashes like all others.
* Text matches byte for byte; other columns of the input are ignored, whatever their names.

Scale: a line met a billion times would fill one range, so each batch of a map task first drops
what is certainly not a first occurrence; hashes are uniform, so the range bounds are arithmetic
and need no sampling pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.llm.common import keyed_rows, partitions, table, text_key

_ORDER = ["h1", "h2", "id", "th", "pos"]


def _firsts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Of each hash in this batch, the earliest row."""
    if not batch.num_rows:
        return batch
    order = pc.sort_indices(pa.table(batch.columns, names=batch.schema.names), sort_keys=[(c, "ascending") for c in _ORDER], null_placement="at_start")
    batch = batch.take(order)
    h1, h2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2"))
    first = np.ones(len(h1), bool)
    first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    return batch.filter(pa.array(first))


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _firsts(batch)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First row of each hash of a sorted range; carries one hash from batch to batch."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2"))
        first = np.ones(len(h1), bool)
        first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        first[0] = last != (h1[0], h2[0])
        last = (h1[-1], h2[-1])
        yield batch.select(["id", "th", "pos", "n"]).filter(pa.array(first))


@F.pandas_udf(StringType())
def _runs(kept: pd.Series, n: pd.Series) -> pd.Series:
    """Run lengths of the bitmap, alternately kept and dropped, the first of them kept (maybe 0)."""

    def one(pos: np.ndarray, size: float) -> str | None:
        if size is None or np.isnan(size):
            return None
        bits = np.zeros(int(size) + 2, bool)
        bits[0] = True
        bits[np.asarray(pos, np.int64) + 1] = True
        bits[-1] = not bits[-2]
        edges = np.flatnonzero(bits[1:] != bits[:-1])
        return ",".join(map(str, np.diff(edges, prepend=0)))

    return pd.Series([one(p, s) for p, s in zip(kept, n)], dtype=object)


def expand_runs(bitmap: str | None) -> list[bool]:
    """The bitmap behind its run lengths, a bool a line."""
    out: list[bool] = []
    for i, size in enumerate(bitmap.split(",") if bitmap else []):
        out += [i % 2 == 0] * int(size)
    return out


def first_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, n_lines, kept): per document the sorted numbers of the lines that stay."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select("id", text_key(F.col("text")).alias("th"), F.split("text", "\n", -1).alias("lines"))
    # element 0 is a marker: it brings the document's size along and keeps documents without lines
    rows = base.select(
        "id", "th", F.size("lines").alias("n"), F.posexplode(F.concat(F.array(F.lit(None).cast("string")), F.coalesce("lines", F.array().cast("array<string>")))).alias("at", "line")
    )
    alone = F.col("line").isNull() | (F.trim(F.regexp_replace("line", "[\t\r]", " ")) == "")
    rows = rows.select(
        F.when(alone, F.xxhash64("id", "th", "at")).otherwise(F.xxhash64("line")).alias("h1"),
        F.when(alone, F.xxhash64(F.lit("alone"), "id", "th", "at")).otherwise(F.xxhash64(F.lit("line"), "line")).alias("h2"),
        "id", "th", (F.col("at") - 1).alias("pos"), F.when(F.col("line").isNull() & (F.col("n") >= 0), F.col("n")).alias("n"),
    )
    n = partitions(spark)
    bound = F.floor((F.col("h1") / F.lit(2.0**64) + F.lit(0.5)) * n).cast("int")
    ranges = rows.mapInArrow(_thin, rows.schema).repartitionById(n, F.least(F.greatest(bound, F.lit(0)), F.lit(n - 1))).sortWithinPartitions(*_ORDER)
    firsts = ranges.mapInArrow(_stream, ranges.select("id", "th", "pos", "n").schema)
    return firsts.groupBy("id", "th").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.when(F.col("pos") >= 0, F.col("pos")))).alias("kept"))


def line_keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_kept, keep_bitmap): the bitmap as alternating run lengths."""
    return first_lines(docs, id_col, text_col).select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_lines"), F.size("kept").cast("long").alias("n_kept"), _runs("kept", "n").alias("keep_bitmap")
    )


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """Documents without the lines that appeared earlier; their other columns as they were.

    A document all of whose written lines go (a copy) goes too; one that had none (null, empty or
    blank text) stays as it is. length_col, where present, becomes the new length.
    """
    kept = first_lines(docs, id_col, text_col).select(F.struct("id", "th").alias("_key"), F.struct("n", "kept").alias("_bitmap"))
    rows = keyed_rows(docs, id_col, text_col)
    text = F.col("_row").getField(text_col)
    joined = rows.join(kept.hint("shuffle_hash"), "_key")
    # the lines are bound to a variable: a lambda would split the text again for each of them
    picked = F.transform(F.array(F.split(text, "\n", -1)), lambda lines: F.array_join(F.transform("_bitmap.kept", lambda p: F.get(lines, p)), "\n"))
    left = F.when(F.size("_bitmap.kept") == F.col("_bitmap.n"), text).otherwise(F.get(picked, F.lit(0)))
    joined = joined.select("_row", F.when(F.col("_bitmap.n").isNull(), text).otherwise(left).alias("_text"))
    written = lambda c: F.length(F.trim(F.translate(c, "\n\t\r", "   "))) > 0
    joined = joined.filter(text.isNull() | written(F.col("_text")) | ~written(text))
    field = lambda c: F.col("_row").getField(c)
    return joined.select(*[
        F.col("_text").alias(c) if c == text_col else F.length("_text").cast(docs.schema[c].dataType).alias(c) if c == length_col and docs.schema[c].dataType.typeName() in ("long", "integer") else field(c).alias(c)
        for c in docs.columns
    ])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_keep_bitmaps(table(spark, sf_dir, "documents"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(generate_series(1, len(parts))) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)
), flagged AS (
  SELECT doc_id, pos,
         CASE WHEN trim(line, ' ' || chr(9) || chr(13)) = '' THEN 1
              WHEN row_number() OVER (PARTITION BY line ORDER BY doc_id NULLS FIRST, pos) = 1 THEN 1
              ELSE 0 END AS keep
  FROM lines
), islands AS (
  SELECT doc_id, pos, keep,
         row_number() OVER (PARTITION BY doc_id ORDER BY pos)
         - row_number() OVER (PARTITION BY doc_id, keep ORDER BY pos) AS island
  FROM flagged
), runs AS (
  SELECT doc_id, min(pos) AS start, keep, count(*) AS size FROM islands GROUP BY doc_id, keep, island
), packed AS (
  SELECT doc_id, sum(size) AS n_lines, sum(size * keep) AS n_kept,
         CASE WHEN min_by(keep, start) = 0 THEN '0,' ELSE '' END
         || string_agg(CAST(size AS VARCHAR), ',' ORDER BY start) AS keep_bitmap
  FROM runs GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n_kept, 0) AS BIGINT) AS n_kept, keep_bitmap
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN packed USING (doc_id)
"""

QUERIES = {"op1_line_dedup": op1_line_dedup}
ORACLE = {"op1_line_dedup": SQL}
