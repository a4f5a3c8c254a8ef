"""BPE encoding and decoding by a table of distinct words.

Texts are split into words by the vocabulary's pattern in Spark, words are counted over the corpus,
and each distinct word that repeats is encoded once. The table, most frequent words first, goes to
all tasks, which look up each document's words and put the ids in their places. Decoding looks up
the piece of each id in the vocabulary's id-to-piece table and strings the pieces together.

The table is held to `table_bytes`, whatever the corpus: rarer words are encoded where they stand,
once in a batch, as are words that occur once in the corpus, which a table can't save any work.
Ids are the same either way. Shuffling the rare words to a join instead would move every document
a second time (to meet its words again), which costs far more than encoding them.

Defined results
---------------
* Null text: null ids, zero words and tokens. Empty text: no ids. Both round-trip.
* Each row is encoded on its own; repeated rows give repeated results; other columns don't matter.
* Special tokens don't exist: their strings are ordinary text.
* Decoding: null ids give null text; an id outside the vocabulary, or null, gives null text for
  its row. Bytes that are not UTF-8 become U+FFFD.

The vocabulary is a parameter: a file of base64 pieces and ranks. It is never trained or copied.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import cut, table, vocabulary_dir
from millrace.llm.pretokens import encoding, pieces, pretokens

RANKS, TABLE_BYTES = "byte_bpe_50k.tiktoken", 24 << 20


def encode_words(words: pa.Array, path: str) -> pa.ListArray:
    """The ids of each word, by byte-pair merges."""
    one = encoding(path).encode_ordinary
    ids = [one(w) for w in words.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array([i for x in ids for i in x], pa.int32()))


def word_table(docs: DataFrame, text_col: str, path: str, table_bytes: int = TABLE_BYTES) -> pa.Table:
    """(word, ids) of the most frequent words that occur twice or more, within table_bytes."""
    counts = docs.select(F.explode(pretokens(F.col(text_col))).alias("word")).groupBy("word").agg(F.count("*").alias("n")).filter("n > 1")
    counts = cut(counts.select("word", F.floor(F.log2("n") * 4).cast("int").alias("grade"), (F.octet_length("word") + 24).alias("size")))
    room, least = table_bytes, None
    for grade, size in sorted(counts.groupBy("grade").agg(F.sum("size")).collect(), reverse=True):  # 4 grades for each doubling
        if size > room:
            break
        room, least = room - size, grade
    if least is None:
        return pa.table({"word": pa.array([], pa.string()), "ids": pa.array([], pa.list_(pa.int32()))})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("word"), encode_words(batch.column("word"), path)], names=["word", "ids"])

    return counts.filter(F.col("grade") >= least).select("word").mapInArrow(encode, "word string, ids array<int>").toArrow().combine_chunks()


class Encoder:
    """Ids of batches of split texts, from the table and, for other words, by merging."""

    def __init__(self, words: pa.Table, path: str):
        self.path = path
        self.words = words.column("word").combine_chunks().cast(pa.string()) if words.num_rows else pa.array([], pa.string())
        self.ids = words.column("ids").combine_chunks().cast(pa.list_(pa.int32())) if words.num_rows else pa.array([], pa.list_(pa.int32()))
        if isinstance(self.words, pa.ChunkedArray):
            self.words, self.ids = self.words.chunk(0), self.ids.chunk(0)

    def encode(self, split: pa.Array, rows: int = 500) -> Iterator[tuple[int, pa.ListArray]]:
        """split: a list of words for each text, null for a null text. Gives (first row, ids), some rows at a time."""
        sizes = split.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = split.flatten().cast(pa.string()).dictionary_encode()
        distinct, at = flat.dictionary, flat.indices
        known = pc.index_in(distinct, value_set=self.words)
        rest = distinct.filter(pc.is_null(known))
        ids = pa.concat_arrays([self.ids.take(known.drop_null()), encode_words(rest, self.path)])
        new = np.asarray(pc.is_null(known).to_numpy(zero_copy_only=False), bool)
        place = np.empty(len(distinct), np.int64)
        place[~new], place[new] = np.arange(len(distinct) - len(rest)), len(distinct) - len(rest) + np.arange(len(rest))
        ids, ends = ids.take(pa.array(place)), np.concatenate([[0], np.cumsum(sizes)])
        for row in range(0, len(split), rows):
            to = min(len(split), row + rows)
            tokens = ids.take(at.slice(ends[row], ends[to] - ends[row]))
            counts = np.concatenate([[0], np.cumsum(tokens.value_lengths().to_numpy(zero_copy_only=False))])
            offsets = counts[ends[row : to + 1] - ends[row]].astype(np.int32)
            nulls = split.slice(row, to - row).is_null()
            yield row, pa.ListArray.from_arrays(pa.array(offsets), tokens.flatten(), mask=nulls if pc.any(nulls).as_py() else None)


def decode_ids(ids: pa.ListArray, path: str) -> pa.Array:
    """The bytes of each list of ids: pieces in their order, strung together; null where an id is unknown."""
    table = pa.array(pieces(path), pa.large_binary())
    sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = ids.flatten()
    ends = np.concatenate([[0], np.cumsum(sizes)])
    known = np.asarray(pc.and_kleene(pc.greater_equal(flat, 0), pc.less(flat, len(table))).fill_null(False).to_numpy(zero_copy_only=False), bool)
    bad = np.concatenate([[0], np.cumsum(~known)])
    found = table.take(pa.array(np.where(known, flat.fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)))
    starts = np.concatenate([[0], np.cumsum(pc.binary_length(found).to_numpy(zero_copy_only=False))]).astype(np.int64)
    data = pa.py_buffer(np.frombuffer(found.buffers()[2], np.uint8)) if len(found) and found.buffers()[2] else pa.py_buffer(b"")
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(starts[ends].astype(np.int64)), data])
    wrong = pa.array(bad[ends[1:]] > bad[ends[:-1]])
    return pc.if_else(pc.or_(ids.is_null(), wrong), pa.scalar(None, pa.large_binary()), whole)


def _joined(words: pa.ListArray) -> pa.Array:
    """The text that each list of words makes up, as bytes; null for a null list."""
    return pc.binary_join(words.cast(pa.list_(pa.binary())), b"").cast(pa.large_binary())


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(doc_id, n_words, n_tokens, token_ids, round_trip) of each row; round_trip: the ids decode to the text."""
    path = ranks or f"{vocabulary_dir()}/{RANKS}"
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(word_table(own, "text", path, table_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value, path)
        for batch in batches:
            for at, ids in encoder.encode(batch.column("words")):
                part = batch.slice(at, len(ids))
                words = part.column("words")
                lengths = [x.value_lengths().fill_null(0).cast(pa.int64()) for x in (words, ids)]
                same = pc.equal(decode_ids(ids, path), _joined(words))
                same = pc.and_(same, pc.equal(pc.cast(pc.binary_length(_joined(words)), pa.int64()), part.column("size"))).fill_null(True)
                yield pa.RecordBatch.from_arrays([part.column("id"), *lengths, ids, same], names=["id", "n_words", "n_tokens", "token_ids", "round_trip"])

    rows = own.select("id", F.octet_length("text").cast("long").alias("size"), pretokens(F.col("text")).alias("words"))
    zero = F.lit(0).cast("long")
    schema = rows.select("id", zero.alias("n_words"), zero.alias("n_tokens"), F.lit(None).cast("array<int>").alias("token_ids"), F.lit(True).alias("round_trip")).schema
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode_corpus(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "token_ids", ranks: str | None = None) -> DataFrame:
    """(doc_id, text) from rows of ids."""
    path = ranks or f"{vocabulary_dir()}/{RANKS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = decode_ids(batch.column("ids"), path)
            texts = pa.array([None if b is None else b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), texts], names=["id", "text"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, rows.select("id", F.lit(None).cast("string").alias("text")).schema).withColumnRenamed("id", id_col)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"))


QUERIES = {"op10_bpe": op10_bpe}
ORACLE: dict[str, str] = {}
