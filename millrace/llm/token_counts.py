"""Edit-aware token counts.

A document's pre-tokens (words, as the vocabulary's pattern splits) lie in leaves of LEAF words; a
segment tree over the leaves sums characters and tokens. An edit descends the tree by character
offset, re-splits from the last leaf boundary that it cannot have moved, and stops at the first
old leaf boundary behind it that is a boundary again. Only those leaves are encoded anew; the sums
above them are updated. Leaves that outgrow their size are split where they stand. The rest of the document
is neither read, split, encoded nor copied: each leaf holds its own piece of the text.

Why that is exact: the pattern looks at most two characters beyond a word and never back, so a
boundary at least two characters before an edit stays, and from a common boundary on equal text
splits equally.

Trees can be kept: `token_trees` returns them as two arrays beside the text (characters and tokens of each leaf), `apply_edits`
takes that table with further edits and returns it brought up to date, without splitting or encoding what no
edit touches. `edited_counts` does both in one pass.

Defined results
---------------
* Null text: null leaves, zero tokens; edits of it are ignored. Empty text: no leaves, zero tokens.
* Edits of a document are applied in their order, each to the text the ones before left; edits of equal seq in
  the order of start, removed, inserted. Start and
  length are in characters and are held to the text's bounds; null counts as 0, null insertions as
  "". A null or empty list of edits changes nothing.
* Each row is counted on its own, so repeated rows give repeated results; other columns don't matter. An empty table gives
  no rows. Long texts are counted whole.
* Edits whose id is not in the corpus are ignored; rows that share an id get the same edits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe import RANKS
from millrace.llm.common import table, vocabulary_dir
from millrace.llm.pretokens import PATTERN, encoding, pretokens

LEAF = 32
_WORDS = regex.compile(PATTERN)
#: Tokens of words met before; emptied when it holds this many.
_KNOWN: dict[str, int] = {}
_KNOWN_WORDS = 300_000
_EDITS = "array<struct<start: int, removed: int, inserted: string>>"


def _tokens(word: str, path: str) -> int:
    n = _KNOWN.get(word)
    if n is None:
        if len(_KNOWN) >= _KNOWN_WORDS:
            _KNOWN.clear()
        n = _KNOWN[word] = len(encoding(path).encode_ordinary(word))
    return n


class TokenTree:
    """Sums of characters and tokens over the pieces of a text; node 1 is the root, leaf i is node size + i."""

    def __init__(self, pieces: list[str], chars: list[int], tokens: list[int]):
        self.pieces = pieces
        self._sum(chars, tokens)

    def _sum(self, chars: list[int], tokens: list[int]) -> None:
        self.leaves = len(chars)
        self.size = 1 << max(0, (max(1, self.leaves) - 1).bit_length())
        empty = [0] * (self.size - self.leaves)
        self.chars_of, self.tokens_of = ([0] * self.size + list(x) + empty for x in (chars, tokens))
        for sums in (self.chars_of, self.tokens_of):
            for node in range(self.size - 1, 0, -1):
                sums[node] = sums[2 * node] + sums[2 * node + 1]

    @property
    def chars(self) -> int:
        return self.chars_of[1]

    @property
    def tokens(self) -> int:
        return self.tokens_of[1]

    @property
    def text(self) -> str:
        return "".join(self.pieces)

    def leaf_sums(self) -> tuple[list[int], list[int]]:
        return tuple(x[self.size : self.size + self.leaves] for x in (self.chars_of, self.tokens_of))

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The last leaf that begins at or before the character, and where it begins."""
        node, start, level = 1, 0, self.size
        while node < self.size:
            left = self.chars_of[2 * node]
            level >>= 1
            right = (2 * node + 1) * level - self.size  # its first leaf
            if char >= start + left and right < self.leaves:
                start, node = start + left, 2 * node + 1
            else:
                node = 2 * node
        return node - self.size, start

    def replace(self, first: int, last: int, pieces: list[str], chars: list[int], tokens: list[int]) -> None:
        """New leaves in the place of those from first to last; sums follow, and only sums are made anew when their number changes."""
        self.pieces[first:last] = pieces
        if len(pieces) == last - first:
            for sums, new in ((self.chars_of, chars), (self.tokens_of, tokens)):
                lo, hi = self.size + first, self.size + last
                sums[lo:hi] = new
                while lo > 1:
                    lo, hi = lo >> 1, (hi + 1) >> 1
                    for node in range(lo, hi):
                        sums[node] = sums[2 * node] + sums[2 * node + 1]
            return
        old = self.leaf_sums()
        for sums, new in zip(old, (chars, tokens)):
            sums[first:last] = new
        self._sum(*old)

    def edit(self, start: int | None, removed: int | None, inserted: str | None, path: str) -> int:
        """Replace text[start:start + removed] by inserted; how many characters were encoded anew."""
        start = min(max(start or 0, 0), self.chars)
        removed = min(max(removed or 0, 0), self.chars - start)
        inserted = inserted or ""
        if not removed and not inserted:
            return 0
        if not self.leaves:
            self.__init__(*_leaves(_WORDS.findall(inserted), path))
            return len(inserted)
        first, begin = self.leaf_at(max(0, start - 2))
        ending, bound = self.leaf_at(start + removed)  # the old leaf that holds the edit's end
        shift = len(inserted) - removed - begin
        ahead = ending + 2
        while True:
            ahead = min(ahead, self.leaves)
            old = "".join(self.pieces[first:ahead])
            new = old[: start - begin] + inserted + old[start + removed - begin :]
            # where old leaves begin, in the new text; words that end near its cut end may be cut themselves
            at, places = bound + self.chars_of[self.size + ending] + shift, {}
            for leaf in range(ending + 1, ahead):
                if ahead == self.leaves or at + 2 < len(new):
                    places.setdefault(at, leaf)
                at += self.chars_of[self.size + leaf]
            words, last = [], None
            for found in _WORDS.finditer(new):
                last = places.get(found.start())
                if last is not None:
                    break
                words.append(found.group())
            if last is not None or ahead == self.leaves:
                break
            ahead += ahead - first
        last = self.leaves if last is None else last
        slots = last - first
        if len(words) > 2 * LEAF * slots:  # grown out of its leaves
            pieces, chars, tokens = _leaves(words, path)
        else:
            step = -(-len(words) // slots) or 1
            pieces, chars, tokens = _leaves(words, path, step)
            gap = slots - len(pieces)
            pieces, chars, tokens = pieces + [""] * gap, chars + [0] * gap, tokens + [0] * gap
        self.replace(first, last, pieces, chars, tokens)
        return sum(chars)


def _leaves(words: list[str], path: str, step: int = LEAF) -> tuple[list[str], list[int], list[int]]:
    """(pieces, characters, tokens) of leaves of so many words."""
    parts = [words[i : i + step] for i in range(0, len(words), step)]
    pieces = ["".join(p) for p in parts]
    return pieces, [len(p) for p in pieces], [sum(_tokens(w, path) for w in p) for p in parts]


def build(text: str, path: str) -> TokenTree:
    """The tree of a text, all of it encoded."""
    return TokenTree(*_leaves(_WORDS.findall(text), path))


def kept_tree(text: str, chars: list[int], tokens: list[int]) -> TokenTree:
    """The tree behind the kept sums of its leaves; nothing is split or encoded."""
    ends = np.cumsum(chars).tolist()
    return TokenTree([text[e - n : e] for e, n in zip(ends, chars)], chars, tokens)


def _built(batch: pa.RecordBatch, path: str) -> Iterator[TokenTree | None]:
    """The tree of each row's text from its words, None for a null; each distinct word of the batch is encoded once."""
    words = batch.column("words")
    sizes = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    coded = words.flatten().cast(pa.string()).dictionary_encode()
    distinct = coded.dictionary
    tokens = np.array([_tokens(w, path) for w in distinct.to_pylist()], np.int64)
    chars = pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
    at = coded.indices.to_numpy(zero_copy_only=False)
    # leaves of all rows at once
    leaves = -(-sizes // LEAF)
    within = np.arange(leaves.sum()) - np.repeat(np.cumsum(leaves) - leaves, leaves)
    cuts = np.repeat(np.cumsum(sizes) - sizes, leaves) + LEAF * within
    sums = [np.add.reduceat(x[at], cuts).tolist() if len(cuts) else [] for x in (chars, tokens)]
    ends = np.cumsum(leaves).tolist()
    for text, n, end in zip(batch.column("text").to_pylist(), leaves.tolist(), ends):
        yield None if text is None else kept_tree(text, sums[0][end - n : end], sums[1][end - n : end])


def _kept(batch: pa.RecordBatch) -> Iterator[TokenTree | None]:
    for text, chars, tokens in zip(*(batch.column(c).to_pylist() for c in ("text", "chars", "tokens"))):
        yield None if text is None or chars is None else kept_tree(text, chars, tokens)


_COUNTS = ["n_tokens", "n_tokens_after", "n_chars_after", "chars_encoded", "n_leaves"]


def _edited(rows: DataFrame, id_col: str, path: str, with_trees: bool) -> DataFrame:
    """(id, counts) of rows of (id, text, words or chars and tokens, edits), with the text and leaves after the edits where they are wanted."""
    splits = "words" in rows.columns
    more = ["text", "leaf_chars", "leaf_tokens"] if with_trees else []
    names, whole = ["id", *more, *_COUNTS], pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for start in range(0, large.num_rows, 2000):
                batch = large.slice(start, 2000)
                out, trees = [], []
                for tree, changes in zip(_built(batch, path) if splits else _kept(batch), batch.column("edits").to_pylist()):
                    if tree is None:
                        out.append((0, 0, 0, 0, 0))
                        trees.append((None, None, None))
                        continue
                    before, anew = tree.tokens, 0
                    for change in changes or []:
                        if change is not None:
                            anew += tree.edit(change["start"], change["removed"], change["inserted"], path)
                    out.append((before, tree.tokens, tree.chars, anew, tree.leaves))
                    if with_trees:
                        trees.append((tree.text, *tree.leaf_sums()))
                columns = [pa.array(x, pa.int64()) for x in zip(*out)] or [pa.array([], pa.int64())] * len(_COUNTS)
                kept = [pa.array([t[k] for t in trees], kind) for k, kind in enumerate((pa.string(), whole, whole))] if with_trees else []
                yield pa.RecordBatch.from_arrays([batch.column("id"), *kept, *columns], names=names)

    empty = F.lit(None).cast("array<int>")
    tree_columns = [F.col("text"), empty.alias("leaf_chars"), empty.alias("leaf_tokens")] if with_trees else []
    schema = rows.select("id", *tree_columns, *[F.lit(0).cast("long").alias(n) for n in _COUNTS]).schema
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def token_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None) -> DataFrame:
    """(doc_id, text, leaf_chars, leaf_tokens): the tree of each row, to be kept and edited later."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), pretokens(text).alias("words"), F.lit(None).cast(_EDITS).alias("edits"))
    return _edited(rows, id_col, ranks or f"{vocabulary_dir()}/{RANKS}", True).select(id_col, "text", "leaf_chars", "leaf_tokens")


def apply_edits(trees: DataFrame, edits: Column, id_col: str = "doc_id", ranks: str | None = None) -> DataFrame:
    """(doc_id, text, leaf_chars, leaf_tokens, counts) after the edits of rows of token_trees; counts as edited_counts has them."""
    rows = trees.select(F.col(id_col).alias("id"), "text", F.col("leaf_chars").alias("chars"), F.col("leaf_tokens").alias("tokens"), edits.cast(_EDITS).alias("edits"))
    return _edited(rows, id_col, ranks or f"{vocabulary_dir()}/{RANKS}", True)


def edited_counts(docs: DataFrame, edits: Column, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_tokens_after, n_chars_after, chars_encoded, n_leaves); edits: array of struct(start, removed, inserted)."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), pretokens(text).alias("words"), edits.cast(_EDITS).alias("edits"))
    return _edited(rows, id_col, ranks or f"{vocabulary_dir()}/{RANKS}", False)


def counts_after(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None) -> DataFrame:
    """As edited_counts, with the edits in a table of (doc_id, seq, start, removed, inserted)."""
    lists = edits.groupBy(F.col(id_col).alias("_id")).agg(F.sort_array(F.collect_list(F.struct("seq", "start", "removed", "inserted"))).alias("_edits"))
    own = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).join(lists, F.col("_doc") == F.col("_id"), "left")
    plain = F.transform("_edits", lambda e: F.struct(e.start.alias("start"), e.removed.alias("removed"), e.inserted.alias("inserted")))
    return edited_counts(own.select(F.col("_doc").alias(id_col), F.col("_text").alias(text_col), plain.alias("_edits")), F.col("_edits"), id_col, text_col, ranks)


def revision(text: Column, lang: Column, source: Column) -> Column:
    """The edits that the query makes: a replacement, an insertion and a removal in each document."""
    third = (F.length(text) / 3).cast("int")
    note = F.concat_ws(" ", F.lit("("), lang, source, F.lit(")"))
    one = lambda start, removed, inserted: F.struct(start.alias("start"), F.lit(removed).alias("removed"), inserted.alias("inserted"))
    return F.array(one(third, 12, note), one(2 * third, 0, F.concat(F.lit(" "), source)), one(F.lit(0), 7, F.lit("")))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return edited_counts(docs, revision(F.col("text"), F.col("lang"), F.col("source")))


QUERIES = {"op3_token_counts": op3_token_counts}
ORACLE: dict[str, str] = {}
