"""N-gram decontamination of a corpus against benchmarks, all benchmarks in one pass."""

from __future__ import annotations

from collections import Counter, defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as t
from millrace.operators.lineage import BROADCAST_BYTES, cut

#: Up to this many bytes of different n-grams are known to the plan by their rarest words; beyond it all n-grams of the corpus are made.
ANCHOR_BYTES = 2 << 20


def words_of(text: Column) -> Column:
    """The words of t.normal(text)."""
    return t.split(F.lower(text))


def anchors(ngrams: list[str]) -> dict[str, int]:
    """A word of each n-gram, the one that fewest n-grams hold, with a bit for each place that it has: an n-gram is found only where that word is."""
    words = [ngram.split(" ") for ngram in ngrams]
    held = Counter(word for own in words for word in set(own))
    out: dict[str, int] = defaultdict(int)
    for own in words:
        at = min(range(len(own)), key=lambda i: (held[own[i]], -len(own[i]), i))
        out[own[at]] |= 1 << at
    return dict(out)


def anchor_slots(spark: SparkSession, found: dict[str, int]) -> tuple[Column, int]:
    """An array that holds at a word's hash the bits of the anchors with that hash; it is folded to one constant. And its size."""
    size = min(1 << 16, 1 << (16 * len(found)).bit_length())
    slots = [0] * size
    words = spark.range(1).select(F.explode(F.split(F.lit(" ".join(found)), " ")).alias("word"))
    for row in words.select("word", F.pmod(F.xxhash64("word"), F.lit(size)).alias("at")).collect():
        slots[row["at"]] |= found[row.word]
    return F.split(F.lit(",".join(map(str, slots))), ",").cast("array<long>"), size


def anchored_ngrams(words: Column, spark: SparkSession, found: dict[str, int], n: int) -> Column:
    """Those n-grams that hold an anchor at its place, and a few others whose words share its hash."""
    if not found:
        return F.array().cast("array<string>")
    slots, size = anchor_slots(spark, found)

    def grams(w: Column) -> Column:
        bits = lambda at: F.get(slots, F.pmod(F.xxhash64(F.get(w, at)), F.lit(size)).cast("int"))
        spots = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda at: bits(at) != 0)
        here = lambda at: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.when(F.call_function("shiftright", bits(at), k) % 2 != 0, at - k))
        starts = lambda at: F.filter(here(at), lambda i: (i >= 0) & (i <= F.size(w) - n))
        made = F.transform(F.array_distinct(F.flatten(F.transform(spots, starts))), lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]))
        return F.when(F.size(w) >= n, made)

    return t.let(words, grams)


def ngram_rows(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(key, ngram), distinct within a row."""
    return df.select(F.col(key), F.explode(F.array_distinct(t.ngrams(words_of(F.col(text)), n))).alias("ngram"))


def inverted_index(benchmark: DataFrame, key: str = "item_id", text: str = "text", n: int = 8) -> DataFrame:
    """(ngram, items): the sorted keys of the items that hold it."""
    return ngram_rows(benchmark, key, text, n).groupBy("ngram").agg(F.sort_array(F.collect_set(key)).alias("items"))


def flags(corpus: DataFrame, benchmarks: dict[str, DataFrame], key: str = "doc_id", text: str = "text", benchmark_text: str = "text", n: int = 8) -> DataFrame:
    """The corpus with a contaminated_<name> column for each benchmark; its n-grams are made once, and of
    benchmarks that are small enough only where an n-gram's rarest word is.

    A row is known by its key and the hash of its text, so null and shared keys are flagged like others. Only the rows
    that hit come back from the join; they are broadcast where their checked size allows, and the corpus stays where it is.
    """
    parts = [b.select(F.lit(name).alias("benchmark"), F.explode(t.ngrams(words_of(F.col(benchmark_text)), n)).alias("ngram")) for name, b in benchmarks.items()]
    lookup = cut(reduce(DataFrame.unionByName, parts).distinct())
    size = lookup.agg(F.sum(F.octet_length("ngram") + 48)).first()[0] or 0
    row = F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("text"))
    words = words_of(F.col(text))
    few = size <= ANCHOR_BYTES and n < 64
    made = anchored_ngrams(words, corpus.sparkSession, anchors([r.ngram for r in lookup.select("ngram").distinct().collect()]), n) if few else t.ngrams(words, n)
    grams = corpus.select(row.alias("row"), F.explode(made).alias("ngram"))
    if size <= BROADCAST_BYTES:
        found = grams.join(F.broadcast(lookup), "ngram")
    else:  # only 128 bits of each n-gram are shuffled
        hashed = lambda df: df.withColumn("ngram", F.struct(F.xxhash64("ngram").alias("a"), F.xxhash64(F.lit("ngram"), "ngram").alias("b")))
        found = hashed(grams).join(hashed(lookup), "ngram")
    names = [f"contaminated_{name}" for name in benchmarks]
    hits = cut(found.groupBy("row").agg(*[F.bool_or(F.col("benchmark") == name).alias(f"contaminated_{name}") for name in benchmarks]))
    if hits.count() * 64 <= BROADCAST_BYTES:
        hits = F.broadcast(hits)
    own = F.struct(*[F.col(f"`{c}`") for c in corpus.columns])
    marked = corpus.select(own.alias("own"), row.alias("row")).join(hits, "row", "left")
    return marked.select(*[F.col("own").getField(c).alias(c) for c in corpus.columns if c not in names], *[F.coalesce(c, F.lit(False)).alias(c) for c in names])


def cleanup(flagged: DataFrame) -> DataFrame:
    """Rows without any flag, and without the flag columns."""
    names = [c for c in flagged.columns if c.startswith("contaminated_")]
    return flagged.filter(~reduce(lambda a, b: a | b, [F.col(c) for c in names])).drop(*names)


def report(flagged: DataFrame) -> DataFrame:
    """(benchmark, removed): a row counts for the first benchmark that removes it."""
    names = [c for c in flagged.columns if c.startswith("contaminated_")]
    first = F.coalesce(*[F.when(F.col(c), c.removeprefix("contaminated_")) for c in names])
    return flagged.select(first.alias("benchmark")).filter("benchmark IS NOT NULL").groupBy("benchmark").agg(F.count("*").alias("removed"))
