"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words of documents and items are hashed. Every word trigram of an item is a seed: an edited copy keeps
some of them, and which ones cannot be told from how rare they are. One pass over the documents looks
the seeds up and aligns each item with the passage round its seeds by Smith-Waterman over words (match
+2, mismatch -1, gap -1). The score is the alignment's share of a perfect copy's; a document holds an
item from `min_score` on. Passages that share too few words with the item to reach that are not
aligned, which loses nothing. A copy is found if three words in a row are left anywhere in it.

Defined results
---------------
* Words are runs of letters and digits, lower case. An item of under `min_words` words proves nothing when edited:
  it is found only where all its words stand in a row, with the score 1. Items without words (null, empty)
  match nothing, as do null and empty documents.
* Each row is judged on its own: repeated rows give repeated results; other columns don't matter.
* Per row and item the best passage counts, the first of equals. Items with the same id are
  separate rows of the benchmark and may both be reported.
* An empty benchmark or corpus gives no rows. Long texts are read to their end.

Scale: no document moves. What is sent to tasks is a slice of the benchmark of at most SLICE_WORDS
words; a larger benchmark is worked off slice by slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from millrace.llm.common import table

SEED, MIN_WORDS, MIN_SCORE, SLICE_WORDS = 3, 8, 0.5, 4_000_000
_TABLE_BITS = 22


def word_hashes(text: Column) -> Column:
    return F.transform(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""), lambda w: F.xxhash64(w))


def seed_hashes(words: np.ndarray, size: int = SEED) -> np.ndarray:
    """A hash for each run of `size` words; len(words) - size + 1 of them."""
    w = words.view(np.uint64)
    n = max(0, len(w) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out ^ w[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


class Seeds:
    """Finds known seed hashes among many: a bit table first, then a sorted search."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[(self.sorted >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True

    def find(self, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, position, index of the seed) of each hit."""
        h = seed_hashes(words)
        at = np.flatnonzero(self.table[(h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
        which = np.searchsorted(self.sorted, h[at])
        which[which == len(self.sorted)] = 0
        some = self.sorted[which] == h[at] if len(self.sorted) else np.zeros(0, bool)
        at, which = at[some], which[some]
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + SEED <= offsets[doc + 1] if len(at) else np.zeros(0, bool)
        return doc[inside], (at - offsets[doc])[inside], which[inside]


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> np.ndarray:
    """Smith-Waterman score of each item with its passage; all at once, row by row of the item."""
    k, rows, width = len(items), max(map(len, items)), max(map(len, passages))
    a, b = np.zeros((k, rows), np.int64), np.ones((k, width), np.int64)
    for i, (x, y) in enumerate(zip(items, passages)):
        a[i, : len(x)], b[i, : len(y)] = x, y
    real_a = np.arange(rows) < np.array([len(x) for x in items])[:, None]
    real_b = np.arange(width) < np.array([len(x) for x in passages])[:, None]
    step = np.arange(1, width + 1, dtype=np.int32)
    last, best = np.zeros((k, width + 1), np.int32), np.zeros(k, np.int32)
    for i in range(rows):
        same = (a[:, i : i + 1] == b) & real_b & real_a[:, i : i + 1]
        new = np.maximum(np.maximum(last[:, :-1] + np.where(same, 2, -1), last[:, 1:] - 1), 0)
        last[:, 1:] = np.maximum.accumulate(new + step, axis=1) - step  # a gap costs 1 a word
        best = np.maximum(best, last.max(1))
    return best


class Slice:
    """A slice of the benchmark as tasks use it: words of the items, and at which places of items a seed occurs."""

    def __init__(self, items: list[np.ndarray], min_words: int = MIN_WORDS):
        self.items, self.sets = items, [np.unique(x) for x in items]
        self.sizes = np.array([len(x) for x in items], np.int64)
        short = self.sizes < max(min_words, SEED)
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of short items, by size: sorted hashes, items
        for n in np.unique(self.sizes[short]).tolist():
            own = np.flatnonzero(short & (self.sizes == n))
            whole = np.array([seed_hashes(items[i], n)[0] for i in own], np.uint64)
            order = np.argsort(whole, kind="stable")
            self.short[n] = whole[order], own[order]
        hashes = [seed_hashes(x) if not s else np.zeros(0, np.uint64) for x, s in zip(items, short)]
        every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.seeds = Seeds(every)
        # the places of seed s are at first[s] to first[s + 1]
        order = np.argsort(every, kind="stable")
        self.item = np.repeat(np.arange(len(items)), [len(h) for h in hashes])[order]
        self.at = np.concatenate([np.arange(len(h)) for h in hashes] or [np.zeros(0, np.int64)])[order]
        self.first = np.append(np.searchsorted(every[order], self.seeds.sorted), len(every))

    def passages(self, words: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, from, to) of the passages round seeds on near diagonals."""
        d, p, s = self.seeds.find(words, offsets)
        times = self.first[s + 1] - self.first[s]
        hit = np.repeat(np.arange(len(s)), times)
        place = np.arange(len(hit)) + np.repeat(self.first[s] - np.cumsum(times) + times, times)
        d, i, diagonal = d[hit], self.item[place], p[hit] - self.at[place]
        order = np.lexsort((diagonal, i, d))
        d, i, diagonal = d[order], i[order], diagonal[order]
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (i[1:] != i[:-1]) | (np.diff(diagonal) > self.sizes[i[1:]])
        low = np.flatnonzero(new)
        high = np.append(low[1:], len(d))[: len(low)] - 1
        d, i, n = d[low], i[low], self.sizes[i[low]]
        slack = n // 2 + 4
        yield from zip(*(x.tolist() for x in (d, i, np.maximum(0, diagonal[low] - slack), np.minimum(offsets[d + 1] - offsets[d], diagonal[high] + n + slack))))

    def whole(self, words: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, item, from) of the first place of each short item in each document."""
        for n, (known, own) in self.short.items():
            h = seed_hashes(words, n)
            first, last = np.searchsorted(known, h), np.searchsorted(known, h, "right")
            found: set[tuple[int, int]] = set()
            for at in np.flatnonzero(last > first).tolist():
                d = int(np.searchsorted(offsets, at, "right")) - 1
                for i in own[first[at] : last[at]].tolist() if at + n <= offsets[d + 1] else ():
                    if (d, i) not in found and (words[at : at + n] == self.items[i]).all():
                        found.add((d, i))
                        yield d, i, at - int(offsets[d])

    def match(self, words: np.ndarray, offsets: np.ndarray, min_score: float) -> list[tuple[int, int, float, int, int]]:
        """(document, item, score, passage from, to) of each document that holds an item."""
        todo = []
        for d, i, a, b in self.passages(words, offsets):
            n, own, passage = len(self.items[i]), self.sets[i], words[offsets[d] + a : offsets[d] + b]
            # each match of an alignment takes a word of the passage that the item has too
            if np.count_nonzero(own[np.minimum(np.searchsorted(own, passage), len(own) - 1)] == passage) >= min_score * n:
                todo.append((n, d, i, a, b))
        todo.sort(key=lambda x: (x[4] - x[3], x[0]))
        best: dict[tuple[int, int], tuple[float, int, int]] = {(d, i): (1.0, a, a + len(self.items[i])) for d, i, a in self.whole(words, offsets)}
        at = 0
        while at < len(todo):
            to = at + 1
            while to < len(todo) and to - at < 512 and (to - at + 1) * (todo[to][4] - todo[to][3]) < 2_000_000:
                to += 1
            part = todo[at:to]
            scores = align([self.items[i] for _, _, i, _, _ in part], [words[offsets[d] + a : offsets[d] + b] for _, d, _, a, b in part])
            for (n, d, i, a, b), score in zip(part, scores.tolist()):
                share = score / (2 * n)
                if share >= min_score and ((d, i) not in best or (-share, a) < (-best[d, i][0], best[d, i][1])):
                    best[d, i] = (share, a, b)
            at = to
        return [(d, i, *x) for (d, i), x in sorted(best.items())]


def _flat(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    n = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return words.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(n)]).astype(np.int64)


def slices(benchmark: DataFrame, item_col: str, text_col: str, min_words: int) -> Iterator[tuple[list, Slice]]:
    """(item ids, slice)"""
    rows = benchmark.select(F.col(item_col).alias("item"), word_hashes(F.col(text_col)).alias("words")).filter(F.size("words") > 0)
    names, held, size = [], [], 0
    for row in rows.toLocalIterator():  # at most SLICE_WORDS words and an item are held at a time
        names.append(row.item)
        held.append(np.array(row.words, np.int64))
        size += len(row.words)
        if size >= SLICE_WORDS:
            yield names, Slice(held, min_words)
            names, held, size = [], [], 0
    if held:
        yield names, Slice(held, min_words)


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", min_score: float = MIN_SCORE, min_words: int = MIN_WORDS
) -> DataFrame:
    """(doc_id, item_id, score, passage_from, passage_to): the passage in words of the document."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = [docs.schema[id_col].dataType, benchmark.schema[item_col].dataType]
    schema = StructType([StructField("id", kind[0]), StructField("item", kind[1]), StructField("score", DoubleType()), StructField("passage_from", LongType()), StructField("passage_to", LongType())])
    batch_type = to_arrow_type(kind[1])
    out = docs.sparkSession.createDataFrame([], schema)
    for names, part in slices(benchmark, item_col, item_text_col, min_words):
        sent = docs.sparkSession.sparkContext.broadcast((names, part))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            names, part = sent.value
            for batch in batches:
                found = part.match(*_flat(batch.column("words")), min_score)
                d, i, score, a, b = map(list, zip(*found)) if found else ([],) * 5
                ids = batch.column("id").take(pa.array(d, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([names[x] for x in i], batch_type), pa.array(score, pa.float64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=schema.names)

        out = out.unionByName(own.select("id", word_hashes(F.col("text")).alias("words")).mapInArrow(run, schema))
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "score", "passage_from", "passage_to")


def _holds(sent, min_score: float):
    @F.pandas_udf(BooleanType())
    def holds(words: pd.Series) -> pd.Series:
        arrays = [np.zeros(0, np.int64) if w is None else np.asarray(w, np.int64) for w in words]
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in arrays])]).astype(np.int64)
        out = np.zeros(len(arrays), bool)
        if offsets[-1]:
            out[[d for d, *_ in sent.value.match(np.concatenate(arrays), offsets, min_score)]] = True
        return pd.Series(out)

    return holds


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", min_score: float = MIN_SCORE, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows that hold no item, with all their columns; nothing is joined or moved."""
    kept = docs
    for _, part in slices(benchmark, item_col, item_text_col, min_words):
        sent = docs.sparkSession.sparkContext.broadcast(part)
        kept = kept.filter(~_holds(sent, min_score)(word_hashes(F.col(text_col))))
    return kept


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op7_decontaminate": op7_decontaminate}
ORACLE: dict[str, str] = {}
