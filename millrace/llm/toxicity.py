"""Toxicity by compression distance.

Two zstandard dictionaries are trained, on windows of ordinary and of toxic documents. Each window of a
document, a word between spaces, is compressed with the ordinary dictionary and with the ordinary one joined by
the toxic one, so that the difference of the two lengths is what toxic text alone explains. A window is
toxic when its length drops by `drop` bytes or more and no more than `rest` bytes are left of it, a document
with `windows` such windows is. The three thresholds are calibrated on labelled documents kept out of the
training.

Labels speak of documents, but nearly all of a toxic document is ordinary, so training goes in rounds.
The first toxic dictionaries are trained on all text of toxic documents, in windows of some words, one
dictionary for each fold of them that is left out. In each round the dictionary of the other folds judges the windows
of a fold; those that shrink, with little left, are kept for the next training. How far they must
shrink is the laxest pair of bounds at which ordinary windows would give at most the round's share
of what is kept (ROUNDS). Ordinary windows that shrink under the new toxic dictionary are false alarms
and join the ordinary dictionary, so their text explains nothing any more. Only compressed lengths choose.

In the training, a word copied with its neighbours is one window. Two spaces stand before and behind each word: a match must
outweigh what naming it costs. Every window begins with one anchor that ends both dictionaries.

Bounds of the fit, all parameters: `fit_rows` labelled documents, of them `ordinary_windows` and
`toxic_windows` windows, each the first by hash, so that every document gives its share. Samples are drawn in Spark;
the driver never holds a whole text. Scoring sees every window of every document; a word that repeats
among some documents is compressed once for them.

Defined results
---------------
* Null text and text without words: no windows, not toxic. An empty table gives no rows.
* No usable labels, only one class, or too little text to train on: nothing is toxic.
* Several labels of one id: the highest counts; null labels are ignored.
* Thresholds of equal F1 on the held-out documents: the smallest drop, then the least rest, then the fewest windows.
* Each row is judged on its own, so repeated rows get equal results; other columns don't matter. Long
  texts are read to their end. A run of over 80 bytes without a space is cut into windows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table

FIT_ROWS, ORDINARY_WINDOWS, TOXIC_WINDOWS = 14_000, 120_000, 150_000
ORDINARY_BYTES, TOXIC_BYTES, ALARM_BYTES = 65_536, 65_536, 131_072
#: The share of chance among the windows that a round may keep.
ROUNDS = (0.6, 0.4, 0.2, 0.1, 0.05)
PARTS, DROPS, RESTS = 4, range(2, 11), range(1, 4)  # the last part is held out for the calibration
_GAP, _ANCHOR = b"  ", bytes(range(128, 140))
_WIDE, _WORD = re.compile(rb"\S[^\n]{0,16}\S{0,64}"), re.compile(rb"\S{1,80}")
_SLICE, _BLOCK, _KNOWN = 20_000, 200_000, 250_000


def windows(text: str) -> list[bytes]:
    return _WORD.findall(text.lower().encode("utf-8", "replace"))


def wide(text: str) -> list[bytes]:
    """Windows of whole words, some 16 bytes or more, within a line."""
    return [_GAP.join(w.split()) for w in _WIDE.findall(text.lower().encode("utf-8", "replace"))]


def in_context(text: str) -> list[bytes]:
    """Each window with the one before and the one after it, which tell copies apart from new uses."""
    words = [b"^", *windows(text), b"$"]
    return [b" ".join(x) for x in zip(words, words[1:], words[2:])]


def _parameters() -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters(
        window_log=18, chain_log=19, hash_log=17, search_log=5, min_match=3, target_length=32, strategy=zstandard.STRATEGY_BTLAZY2,
        write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(content + _ANCHOR, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=_parameters())
    return zstandard.ZstdCompressor(dict_data=known, compression_params=_parameters())


def framed(window: bytes) -> bytes:
    return _ANCHOR + _GAP + window + _GAP


def lengths(with_: zstandard.ZstdCompressor, found: list[bytes], threads: int = 1) -> np.ndarray:
    """The compressed length of each window."""
    out = np.empty(len(found), np.int64)
    for at in range(0, len(found), _SLICE):
        part = [framed(w) for w in found[at : at + _SLICE]]
        sizes = np.array([len(w) for w in part], "<u8")
        places = np.stack([np.cumsum(sizes) - sizes, sizes], 1)
        packed = with_.multi_compress_to_buffer(zstandard.BufferWithSegments(b"".join(part), places.tobytes()), threads=threads)
        out[at : at + len(part)] = [len(x) for x in packed]
    return out


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    drop: int = 1
    rest: int = 1
    windows: int = 1

    def compressors(self) -> tuple | None:
        return (compressor(self.ordinary), compressor(self.ordinary + self.toxic)) if self.toxic else None


def judged(found: list[bytes], pair: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Of each window, by how many bytes the toxic dictionary shortens it and how many are left."""
    after = lengths(pair[1], found)
    return lengths(pair[0], found) - after, after - lengths(pair[1], [b""])[0]


def judged_texts(texts: list[str | None], pair: tuple | None, known: dict[bytes, tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(drop, rest) of the windows of each text; some texts at a time. known keeps those of windows met before and is emptied when full."""
    held: list[bytes] = []
    ends: list[int] = []

    def block() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        coded = pa.array(held, pa.binary()).dictionary_encode()
        at, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        if pair:
            if len(known) > _KNOWN:
                known.clear()
            new = [w for w in distinct if w not in known]
            if new:
                known.update(zip(new, zip(*(x.tolist() for x in judged(new, pair)))))
            found = np.array([known[w] for w in distinct], np.int64).reshape(-1, 2).T
        else:
            found = np.zeros((2, len(distinct)), np.int64)
        yield from zip(*(np.split(x[at], ends[:-1]) for x in found))
        held.clear(), ends.clear()

    for text in texts:
        held += windows(text) if text else []
        ends.append(len(held))
        if len(held) >= _BLOCK:
            yield from block()
    if ends:
        yield from block()


def trained(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary of the samples, or the distinct samples where there are too few to train on."""
    samples = [_GAP + w + _GAP for w in samples]
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, samples)) // 4)), samples, k=32, d=6, f=20, steps=1).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


@dataclass
class Sample:
    """Text to train on: wide windows of ordinary documents; of toxic ones, with their parts, wide windows and windows."""

    ordinary: list[bytes]
    wide: list[bytes]
    wide_part: np.ndarray
    windows: list[bytes]
    part: np.ndarray


def _kept(drop: np.ndarray, rest: np.ndarray, usual: np.ndarray, usual_rest: np.ndarray, share: float) -> np.ndarray:
    """The windows that shrink by a bound and end within another: the laxest bounds that chance gives no more than the share of."""
    best = np.zeros(len(drop), bool)
    for least in range(1, 10):
        for most in range(1, 12):
            kept = (drop >= least) & (rest <= most)
            chance = ((usual >= least) & (usual_rest <= most)).mean() * len(drop)
            if chance <= share * kept.sum() and kept.sum() > best.sum():
                best = kept
    return best


def fit(s: Sample) -> ToxicityModel:
    """The two dictionaries, without thresholds."""
    none = ToxicityModel(b"", b"")
    folds = np.unique(s.part)
    if len(folds) < 2 or len(s.ordinary) < 100 or len(s.wide) < 100:
        return none
    base = trained(s.ordinary, ORDINARY_BYTES)
    usual = [w for part in s.ordinary[-20_000:] for w in part.split()]
    ordinary, chosen, toxic = base, None, b""
    for number, share in enumerate(ROUNDS):
        plain = compressor(ordinary)
        before, usual_before = lengths(plain, s.windows, 4), lengths(plain, usual, 4)
        drop, rest = np.zeros((2, len(s.windows)), np.int64)
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        for fold in folds:
            if chosen is None:
                others = [s.wide[i] for i in np.flatnonzero(s.wide_part != fold)]
            else:
                others = [s.windows[i] for i in np.flatnonzero(chosen & (s.part != fold))]
            known = compressor(ordinary + trained(others, TOXIC_BYTES))
            empty, own = lengths(known, [b""])[0], np.flatnonzero(s.part == fold)
            after, usual_after = lengths(known, [s.windows[i] for i in own], 4), lengths(known, usual, 4)
            drop[own], rest[own] = before[own] - after, after - empty
            seen.append((usual_before - usual_after, usual_after - empty))
        chosen = _kept(drop, rest, *map(np.concatenate, zip(*seen)), share)
        if not chosen.any():
            return none
        toxic = trained([s.windows[i] for i in np.flatnonzero(chosen)], TOXIC_BYTES)
        if number:
            alarms = lengths(plain, s.ordinary, 4) - lengths(compressor(ordinary + toxic), s.ordinary, 4) >= 2
            found = [s.ordinary[i] for i in np.flatnonzero(alarms)]
            ordinary = base + (_GAP.join(found) + _GAP)[:ALARM_BYTES]
    return ToxicityModel(ordinary, toxic)


def calibrated(model: ToxicityModel, counts: np.ndarray, toxic: np.ndarray) -> ToxicityModel:
    """The thresholds of the best F1; counts[i, k, j]: windows of held-out document i that drop by DROPS[k] or more with at most RESTS[j] left."""
    best = (-1.0, DROPS[0], RESTS[0], 1)
    for k, drop in enumerate(DROPS):
        for j, rest in enumerate(RESTS):
            for least in range(1, 5):
                said = counts[:, k, j] >= least
                f1 = 2 * (said & (toxic == 1)).sum() / max(1, said.sum() + toxic.sum())
                if f1 > best[0]:
                    best = (f1, drop, rest, least)
    return ToxicityModel(model.ordinary, model.toxic, *best[1:])


def _cut(cut):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(part, w) for part, text in zip(batch.column("part").to_pylist(), batch.column("text").to_pylist()) for w in dict.fromkeys(cut(text))]
            part, found = map(list, zip(*rows)) if rows else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(found, pa.binary())], names=["part", "window"])

    return run


def _drawn(rows: DataFrame, cut, n: int) -> tuple[list[bytes], np.ndarray]:
    """At most n distinct windows, the first by their hash, each with the first part that has it."""
    found = rows.mapInArrow(_cut(cut), "part int, window binary").groupBy("window").agg(F.min("part").alias("part"))
    got = found.orderBy(F.xxhash64("window"), "window").limit(n).toArrow()
    return got.column("window").to_pylist(), got.column("part").to_numpy().astype(np.int64)


def _counts(model: ToxicityModel, rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, known = sent.value.compressors(), {}
        for batch in batches:
            found = [[int(((d >= least) & (r <= most)).sum()) for least in DROPS for most in RESTS] for d, r in judged_texts(batch.column("text").to_pylist(), pair, known)]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.list_(pa.int64()))], names=["y", "n"])

    got = rows.select("y", "text").mapInArrow(run, "y int, n array<long>").toArrow()
    return np.array(got.column("n").to_pylist(), np.int64).reshape(-1, len(DROPS), len(RESTS)), got.column("y").to_numpy()


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    fit_rows: int = FIT_ROWS, ordinary_windows: int = ORDINARY_WINDOWS, toxic_windows: int = TOXIC_WINDOWS,
) -> ToxicityModel:
    """Fit on at most fit_rows labelled documents, the first by hash of their id."""
    named = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id IS NOT NULL AND y IS NOT NULL")
    named = named.groupBy("id").agg((F.max("y") > 0).cast("int").alias("y"))
    sample = F.broadcast(named.orderBy(F.xxhash64("id"), "id").limit(fit_rows))  # fit_rows bounds it
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(sample, "id").filter("trim(text) <> ''")
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(PARTS)).cast("int"))
    kept, held = rows.filter(F.col("part") < PARTS - 1), rows.filter(F.col("part") == PARTS - 1)
    ordinary, _ = _drawn(kept.filter("y = 0"), wide, ordinary_windows)
    joined, wide_part = _drawn(kept.filter("y = 1"), wide, toxic_windows)
    words, part = _drawn(kept.filter("y = 1"), in_context, toxic_windows)
    model = fit(Sample(ordinary, joined, wide_part, [w.split(b" ")[1] for w in words], part))
    return calibrated(model, *_counts(model, held)) if model.toxic else model


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_windows, toxic_windows, most, toxic): most is the largest drop, in bytes, of a window with no more than the model's rest left."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ["id", "n_windows", "toxic_windows", "most", "toxic"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        pair, known = model.compressors(), {}
        for batch in batches:
            found = list(judged_texts(batch.column("text").to_pylist(), pair, known))
            size = [len(d) for d, _ in found]
            n = np.array([((d >= model.drop) & (r <= model.rest)).sum() for d, r in found], np.int64)
            most = [int(d[r <= model.rest].max(initial=0)) for d, r in found]
            toxic = (n >= model.windows) if model.toxic else np.zeros(len(n), bool)
            columns = [pa.array(size, pa.int64()), pa.array(n), pa.array(most, pa.int64()), pa.array(toxic, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    zero = F.lit(0).cast("long")
    schema = rows.select("id", *[zero.alias(n) for n in names[1:4]], F.lit(True).alias("toxic")).schema
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op2_toxicity": op2_toxicity}
ORACLE: dict[str, str] = {}
