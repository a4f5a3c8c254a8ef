"""Personal identifiers by bootstrapped contextual extraction.

Candidates are words and number groups that hold a digit or an at sign, and values without one that
follow `key =` or `key:`. Strict validators give the seeds: instances of a kind (e-mail, ip, phone,
card, secret) or ordinary ones (versions, years, small numbers). Every candidate induces lexical
patterns: its masked form, that form with the word to its left or right, and the context alone (the
word or two words to the left, the word to the right, both sides). Instances and patterns make a
bipartite graph that Spark scores in rounds: a pattern scores, for each kind, its labelled instances'
share of that kind; an instance takes, by noisy-or over its patterns that score `min_score` with
`min_support` instances or more, the kind that comes out highest, but a kind for which its form speaks
goes before those for which only contexts do. Ordinary seeds compete with the kinds; in a context alone, an instance without a label counts against every kind with the weight
`unknown`, so that words that precede anything prove nothing. High-scoring patterns thus find
identifiers that no validator knows: cards with a wrong check digit, addresses out of range, keys
without their keyword by their form; national phone numbers, ids and passwords of letters by their
context. Rounds end when no label changes and no confidence by a thousandth; after `rounds` without that a warning is given.

Defined results
---------------
* A row for each occurrence of an accepted instance: (doc_id, kind, value, from, to, confidence,
  seed); positions in characters. Documents without one have no row; null and empty texts have none.
* Repeated rows give repeated results, but count once as evidence: support is distinct instances.
* Equal scores go to the kind first in the alphabet. Other columns don't matter.
* A value without digit or at sign is an instance together with the two words before it, and only
  patterns that hold these speak for it: `password = true` says nothing about `debug = true`.
* A run of over 200 characters without a space is one candidate whose form is "long". Context words are
  those within 40 characters of the candidate; of a longer word, its part there.
* Empty tables give no rows. Long texts are searched to their end.

Scale: one narrow pass finds the candidates; only distinct (instance, pattern) pairs are shuffled,
and counts combine before the shuffle. Labels
are broadcast to the occurrences where their checked size allows. Lineage is cut each round.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import BROADCAST_BYTES, cut, table

ROUNDS, MIN_SCORE, MIN_SUPPORT, UNKNOWN = 20, 0.6, 3, 0.25

_CANDIDATE = re.compile(
    r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{2,4}[ .-]?\d{2,6}(?!\d)|(?<!\w)\(\d{2,4}\) ?\d{2,4}[ .-]\d{2,6}(?!\d)|(?<![\w.])\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}(?!\w)"
    r"|(?<![^\s\"'|=<>])[^\s\"'|=<>\d@]*+[\d@][^\s\"'|=<>]*+"
)
_VALUE = re.compile(r"(?<=[\w\"' \t])[=:][ \t]*[\"']?([^\s\"'|=<>:/\d@][^\s\"'|=<>\d@]*+)(?=[\s\"'|<>]|$)")
_EDGE = re.compile(r"^[^\w+(@]+|[^\w)]+$")
_KEYWORD = re.compile(r"(?:token|secret|password|passwd|api[_-]?key|key)$")
_ORDINARY = re.compile(r"v?\d{1,3}(?:\.\d{1,3}){0,2}|(?:19|20)\d\d|\d{1,4}(?:st|nd|rd|th|%|s)?|\d{4}-\d\d-\d\d|\d{1,2}[/.]\d{1,2}[/.]\d{2,4}|\d{1,3}(?:,\d{3})+")


def _luhn(digits: str) -> bool:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def seed_kind(value: str, left: str) -> str | None:
    """The kind of an instance that a validator is sure of."""
    digits = re.sub(r"\D", "", value)
    if re.fullmatch(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,}", value):
        return "email"
    if re.fullmatch(r"\d{1,3}(?:\.\d{1,3}){3}", value) and all(int(x) < 256 for x in value.split(".")):
        return "ip"
    if value.startswith("+") and 9 <= len(digits) <= 15:
        return "phone"
    if re.fullmatch(r"\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}", value) and _luhn(digits):
        return "card"
    if _KEYWORD.search(left) and len(value) >= 12 and digits and re.search("[A-Za-z]", value):
        return "secret"
    return "ordinary" if _ORDINARY.fullmatch(value) else None


def masked(value: str) -> str:
    """Letters as a, short and long digit runs as 9 and 99 to 9999, long hexadecimal strings as h; the rest as it is."""
    if len(value) > 200:
        return "long"
    if re.fullmatch(r"[0-9a-fA-F]{16,}", value) and re.search("[a-fA-F]", value):
        return "h"
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"\d+", lambda m: "9" * min(4, (len(m.group()) + 3) // 4), value))


def _words(text: str) -> list[str]:
    return [re.sub(r"\d+", "9", w.lower()) for w in re.findall(r"[^\W_]+|[=:@#]", text)]


def candidates(text: str) -> list[tuple[int, int, str, str, str, str, str | None]]:
    """(from, to, value, left word, left two words, right word, seed kind) of each candidate, in order."""
    out, end = [], 0
    for a, b in sorted([m.span() for m in _CANDIDATE.finditer(text)] + [m.span(1) for m in _VALUE.finditer(text)]):
        if a < end:  # a value inside a candidate
            continue
        end = b
        edge = _EDGE.match(text[a:b])
        a += edge.end() if edge else 0
        tail = re.search(r"[^\w)]+$", text[a:b])
        b -= len(tail.group()) if tail else 0
        value = text[a:b]
        if not re.search(r"[^\W_]|@", value):
            continue
        before = text[max(0, a - 40) : a]
        words = _words(before)
        left, two, right = "".join(words[-1:]), " ".join(words[-2:]), "".join(_words(text[b : b + 40])[:1])
        key = re.sub(r"[\s=:\"'|]+$", "", before).lower() if left in ("=", ":") or before.endswith(('"', "'")) else ""
        out.append((a, b, value, left, two if len(words) > 1 else "", right, seed_kind(value, key)))
    return out


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(i, *c) for i, text in enumerate(batch.column("text").to_pylist()) for c in candidates(text)]
        at, a, b, value, left, two, right, seed = map(list, zip(*rows)) if rows else ([],) * 8
        instance = [v if re.search(r"[\d@]", v) else f"{t} {v}" for v, t in zip(value, two)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(at, pa.int64())), pa.array(a, pa.int64()), pa.array(b, pa.int64()), *(pa.array(x, pa.string()) for x in (value, instance, [masked(v) for v in value], left, two, right, seed))],
            names=["id", "from", "to", "value", "instance", "form", "left", "two", "right", "seed"],
        )


def _patterns() -> Column:
    """Structs (pattern, alone: of the context alone) of a candidate; those that would say nothing are null."""
    one = lambda alone, there, *parts: F.when(there, F.struct(F.concat_ws(" ", *parts).alias("pattern"), F.lit(alone).alias("alone")))
    is_there = lambda c: F.col(c) != ""
    some, gap = F.col("value") == F.col("instance"), F.lit("<>")
    return F.array(
        one(False, some, "form"),
        one(False, some, "left", "form", F.lit("<")),
        one(False, some, F.lit(">"), "form", "right"),
        one(False, is_there("two"), "two", "form", F.lit("<<")),
        one(True, some & is_there("left"), "left", gap),
        one(True, is_there("two"), "two", F.lit("<"), gap),
        one(True, some & is_there("right"), gap, "right"),
        one(True, some & is_there("left") & is_there("right"), "left", gap, "right"),
        one(True, is_there("two") & is_there("right"), "two", F.lit("<"), gap, "right"),
    )


def label_instances(found: DataFrame, rounds: int = ROUNDS, min_score: float = MIN_SCORE, min_support: int = MIN_SUPPORT, unknown: float = UNKNOWN) -> DataFrame:
    """(instance, kind, confidence, seed) of the labelled distinct instances."""
    edges = found.select("instance", F.explode(_patterns()).alias("p")).filter("p IS NOT NULL").select("instance", "p.pattern", "p.alone").distinct()
    edges = cut(edges)
    # a pattern of fewer instances than min_support never scores
    sizes = cut(edges.groupBy("pattern").agg(F.count("*").alias("size"), F.first("alone").alias("alone")).filter(F.col("size") >= min_support))
    edges = cut(edges.join(sizes.select("pattern"), "pattern", "left_semi").select("instance", "pattern"))
    seeds = found.filter("seed IS NOT NULL").groupBy("instance").agg(F.min_by("seed", F.when(F.col("seed") == "ordinary", 1).otherwise(0)).alias("kind"))
    seeds = cut(seeds.select("instance", "kind", F.lit(1.0).alias("confidence"), F.lit(True).alias("seed")))
    labels, before = seeds, None
    for _ in range(rounds):
        mass = edges.join(labels, "instance").groupBy("pattern", "kind").agg(F.sum("confidence").alias("mass"), F.count("*").alias("support"))
        own = Window.partitionBy("pattern")
        mass = mass.select("*", F.sum("mass").over(own).alias("total"), F.sum("support").over(own).alias("known")).join(sizes, "pattern")
        total = F.col("total") + F.when(F.col("alone"), unknown * (F.col("size") - F.col("known"))).otherwise(0.0)
        scored = mass.withColumn("score", F.col("mass") / (total + 1)).filter((F.col("score") >= min_score) & (F.col("support") >= min_support)).select("pattern", "kind", "score", "alone")
        taken = edges.join(scored, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("score"))))).alias("confidence"), (F.bool_and("alone") | (F.col("kind") == "ordinary")).alias("weak"))
        best = taken.groupBy("instance").agg(F.min(F.struct("weak", (-F.col("confidence")).alias("low"), "kind")).alias("best")).select("instance", F.col("best.kind").alias("kind"), (-F.col("best.low")).alias("confidence"), F.lit(False).alias("seed"))
        labels = cut(seeds.unionByName(best.join(seeds.select("instance"), "instance", "left_anti")))
        state = F.xxhash64("instance", "kind", F.round("confidence", 3))
        after = tuple(labels.agg(F.count("*"), F.sum(state.cast("decimal(38,0)"))).first())
        if after == before:
            break
        before = after
    else:
        warnings.warn(f"the labels still change after {rounds} rounds", stacklevel=2)
    return labels


def identifiers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters: float) -> DataFrame:
    """(doc_id, kind, value, from, to, confidence, seed) of each identifier."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").rlike("[0-9@=:]"))
    text = F.lit(None).cast("string")
    place = F.lit(0).cast("long")
    schema = rows.select("id", place.alias("from"), place.alias("to"), *[text.alias(c) for c in ("value", "instance", "form", "left", "two", "right", "seed")]).schema
    found = cut(rows.mapInArrow(_extract, schema))
    labels = cut(label_instances(found, **parameters).filter("kind <> 'ordinary'"))
    size = labels.agg(F.sum(F.octet_length("instance") + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        labels = F.broadcast(labels)  # else a shuffled join, whose hot values adaptive execution splits
    return found.select("id", "from", "to", "value", "instance").join(labels, "instance").select(F.col("id").alias(id_col), "kind", "value", "from", "to", "confidence", "seed")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identifiers(table(spark, sf_dir, "documents"))


QUERIES = {"op6_pii": op6_pii}
ORACLE: dict[str, str] = {}
