"""The ten operators against brute force, and on nulls, empty and long texts, ties, repeats and clashing columns."""

import random
import re

import numpy as np
import pytest
from oracle import differences
from pyspark.sql import functions as F

from millrace.llm import bpe, components, decontaminate, line_dedup, pii, quality_classifier, quality_rules, sharding, simhash, token_counts, toxicity
from millrace.llm.common import vocabulary_dir
from millrace.llm.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, lang string, source string, n_chars long"
PATH = f"{vocabulary_dir()}/{bpe.RANKS}"


def words(rng, n, stock=4000):
    return " ".join(f"w{rng.randrange(stock)}x" for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, shared ids, and columns with internal names."""
    rng = random.Random(1)
    rows = [(1, "a\nb\na"), (2, None), (3, ""), (4, " \n\t"), (5, words(rng, 60_000)), (6, "x" * 80_000), (7, "b\nc"), (7, "b\nc"), (8, "one text"), (8, "another text"), (None, "a"), (9, "!!! ..."), (10, "😀 é \x1c z")]
    extra = ", th long, pos int, kept string, id string, fp string, `key` string, words string, host string, _row int, _key string, score double"
    return spark.createDataFrame([(i, t, None, None if k % 2 else "s", len(t) if t else None, 1, 2, "k", None, "f", "y", "w", "h", 3, "q", 0.5) for k, (i, t) in enumerate(rows)], DDL + extra)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DDL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    assert differences(QUERIES[name](spark, SF), ORACLE[name], SF) == ""


# line dedup


def first_occurrences(rows):
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        bits = []
        for line in [] if text is None else text.split("\n"):
            bits.append(not line.strip(" \t\r") or line not in seen)
            seen.add(line)
        out[i] = None if text is None else bits
    return out


def test_line_dedup(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect() if r.doc_id != 8]
    got = line_dedup.line_keep_bitmaps(odd.filter("doc_id <> 8 OR doc_id IS NULL")).collect()
    want = first_occurrences(rows)
    assert len(got) == len(want)
    for r in got:
        assert (None if r.keep_bitmap is None else line_dedup.expand_runs(r.keep_bitmap)) == want[r.doc_id]
        assert r.n_lines == len(want[r.doc_id] or []) and r.n_kept == sum(want[r.doc_id] or [])
    assert line_dedup.line_keep_bitmaps(odd).filter("doc_id = 8").count() == 2
    assert line_dedup.line_keep_bitmaps(none).count() == 0


def test_line_dedup_random(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["l", "m ", " ", "n", str(rng.randrange(40))]) for _ in range(rng.randrange(1, 30)))) for i in range(120)]
    got = line_dedup.line_keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    want = first_occurrences(rows)
    assert {r.doc_id: line_dedup.expand_runs(r.keep_bitmap) for r in got} == want


def test_drop_repeated_lines(spark, odd, none):
    out = line_dedup.drop_repeated_lines(odd)
    assert out.columns == odd.columns and out.dtypes == odd.dtypes
    texts = [(r.doc_id, r.text, r.n_chars) for r in out.collect()]
    assert {(1, "b", 1), (2, None, None), (3, "", 0), (4, " \n\t", 3), (7, "c", 1), (None, "a", 1)} <= set(texts)
    assert len(texts) == len(set(texts))  # of repeated rows one stays
    lines = [x for _, text, _ in texts if text for x in text.split("\n") if x.strip()]
    assert len(lines) == len(set(lines))
    assert line_dedup.drop_repeated_lines(none).count() == 0


# toxicity


def toxic_corpus(n, seed):
    rng = random.Random(seed)
    syllables = ["the", "an", "er", "on", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it"]
    bad = ["vilebrag", "scumquat", "grotnaz", "moronique", "trashwald"]
    rows = []
    for i in range(n):
        w = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(30, 150))]
        toxic = int(rng.random() < 0.25)
        for _ in range(rng.randrange(3, 7) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w), toxic))
    return rows


def test_toxicity(spark, odd, none):
    rows = toxic_corpus(900, 5)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df, df.filter("doc_id < 600").select("doc_id", "toxic"))
    got = {r.doc_id: r.toxic for r in toxicity.score(df, model).collect()}
    held = [(got[i], y == 1) for i, _, y in rows if i >= 600]
    assert sum(a and b for a, b in held) / sum(b for _, b in held) > 0.9
    assert sum(a and not b for a, b in held) / sum(not b for _, b in held) < 0.05
    assert toxicity.score(odd, model).filter("doc_id IN (2, 3, 4) AND (toxic OR n_windows > 0)").count() == 0
    assert toxicity.score(odd, model).count() == odd.count() and toxicity.score(none, model).count() == 0
    blind = toxicity.train(df, none.select("doc_id", F.lit(1).alias("toxic")))
    assert toxicity.score(df, blind).filter("toxic").count() == 0
    tail = spark.createDataFrame([(1, rows[0][1] * 200 + " scumquat vilebrag grotnaz moronique trashwald")], "doc_id long, text string")
    assert toxicity.score(tail, model).first().toxic  # the end of a long text counts


def test_windows_cover_the_text():
    for text in ("a b  c" * 300, "x" * 1000, " a ", "", "Ä\n\tß é"):
        for cut in (toxicity.windows, toxicity.wide):
            assert b"".join(b"".join(cut(text)).split()) == "".join(text.lower().split()).encode()


def test_toxicity_against_one_window_at_a_time(spark, odd):
    rows = toxic_corpus(500, 6)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df, df.select("doc_id", "toxic"), fit_rows=400)
    assert model.toxic
    plain, both = model.compressors()
    size = lambda c, w: len(c.compress(toxicity.framed(w)))
    empty, want = size(both, b""), {}
    for i, text, _ in rows[:60]:
        found = [(size(plain, w) - size(both, w), size(both, w) - empty) for w in re.findall(rb"\S{1,80}", text.lower().encode())]
        n = sum(d >= model.drop and r <= model.rest for d, r in found)
        want[i] = (len(found), n, max([d for d, r in found if r <= model.rest], default=0), n >= model.windows)
    got = toxicity.score(df.filter("doc_id < 60"), model).collect()
    assert {r.doc_id: (r.n_windows, r.toxic_windows, max(r.most, 0), r.toxic) for r in got} == {i: (a, b, max(c, 0), d) for i, (a, b, c, d) in want.items()}
    again = toxicity.train(df.repartition(5), df.select("doc_id", "toxic"), fit_rows=400)
    assert again == model  # samples don't depend on the layout of the table


def test_equal_thresholds():
    counts = np.zeros((4, len(toxicity.DROPS), len(toxicity.RESTS)), int)
    counts[:2] = 3
    model = toxicity.calibrated(toxicity.ToxicityModel(b"a", b"b"), counts, np.array([1, 1, 0, 0]))
    assert (model.drop, model.rest, model.windows) == (toxicity.DROPS[0], toxicity.RESTS[0], 1)


# token counts


def random_edits(rng, letters, text, n):
    out = []
    for _ in range(n):
        out.append((rng.randint(-2, len(text) + 2), rng.choice([0, 1, 5, 400]), "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 6, 200, 3000])))))
        start = min(max(out[-1][0], 0), len(text))
        text = text[:start] + out[-1][2] + text[start + out[-1][1] :]
    return out, text


def test_token_edits():
    rng = random.Random(7)
    letters, touched, total = "ab c\n  '\tsdlreve12!?é😀x ", 0, 0
    for _ in range(250):
        text = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 40, 300, 3000])))
        tree = token_counts.build(text, PATH)
        for _ in range(4):
            (edit,), text = random_edits(rng, letters, text, 1)
            touched, total = touched + tree.edit(*edit, PATH), total + len(text)
            whole = token_counts.build(text, PATH)
            assert (tree.tokens, tree.chars, tree.text) == (whole.tokens, len(text), text)
            assert [token_counts.build(p, PATH).chars for p in tree.pieces] == tree.leaf_sums()[0]
    assert touched < 0.6 * total


@pytest.mark.parametrize("size", [10, 400, 3000])
def test_large_insertions_encode_their_region_only(size):
    rng = random.Random(size)
    text, new = words(rng, 20_000), words(rng, size)
    tree = token_counts.build(text, PATH)
    assert tree.edit(len(text) // 2, 0, new, PATH) < len(new) + 3 * 10 * token_counts.LEAF
    assert tree.tokens == token_counts.build(tree.text, PATH).tokens and max(map(len, tree.pieces)) < 40 * token_counts.LEAF


def test_kept_trees(spark, odd, none):
    rng = random.Random(12)
    letters = "ab c\n  'sdlreve12!?é😀x "
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.choice([0, 30, 2000])))) for i in range(40)] + [(99, None)]
    trees = token_counts.token_trees(spark.createDataFrame(rows, "doc_id long, text string"))
    kind, texts = "doc_id long, edits array<struct<start:int,removed:int,inserted:string>>", dict(rows)
    for _ in range(3):
        made = {}
        for i, text in texts.items():
            made[i], texts[i] = random_edits(rng, letters, text, 2) if text is not None else ([(0, 1, "x")], None)
        trees = token_counts.apply_edits(trees.join(spark.createDataFrame(list(made.items()), kind), "doc_id"), F.col("edits"))
        got = trees.collect()
        for r in got:
            whole = token_counts.build(texts[r.doc_id] or "", PATH)
            assert (r.text, r.n_tokens_after, r.n_chars_after) == (texts[r.doc_id], whole.tokens, whole.chars)
            assert r.text is None or (sum(r.leaf_chars), sum(r.leaf_tokens)) == (whole.chars, whole.tokens)
        trees = spark.createDataFrame([(r.doc_id, r.text, r.leaf_chars, r.leaf_tokens) for r in got], "doc_id long, text string, leaf_chars array<int>, leaf_tokens array<int>")
    assert token_counts.token_trees(odd).count() == odd.count() and token_counts.token_trees(none).count() == 0


def test_token_query_against_plain_python(spark):
    from millrace.llm.pretokens import encoding

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, split = encoding(PATH), token_counts._WORDS.findall
    count = lambda text: sum(len(one.encode_ordinary(w)) for w in split(text))
    want = {}
    for r in docs.collect():
        text, after, n = r.text or "", r.text or "", len(r.text or "")
        for start, removed, inserted in ((n // 3, 12, f"( {r.lang} {r.source} )"), (2 * (n // 3), 0, f" {r.source}"), (0, 7, "")) if r.text is not None else ():
            start = min(start, len(after))
            after = after[:start] + inserted + after[start + removed :]
        want[r.doc_id] = (count(text), count(after), len(after))
    got = {r.doc_id: (r.n_tokens, r.n_tokens_after, r.n_chars_after) for r in QUERIES["op3_token_counts"](spark, SF).collect()}
    assert got == want


def test_token_counts(spark, odd, none):
    from millrace.llm.pretokens import encoding

    one = encoding(PATH)
    edits = spark.createDataFrame([(1, 2, 0, 1, "Z "), (1, 1, 3, 9, None), (10, 1, None, None, "new"), (77, 1, 0, 1, "")], "doc_id long, seq int, start int, removed int, inserted string")
    got = sorted(((r.doc_id, r.n_tokens, r.n_tokens_after, r.n_chars_after) for r in token_counts.counts_after(odd, edits).collect()), key=str)
    split = token_counts._WORDS.findall
    count = lambda text: sum(len(one.encode_ordinary(w)) for w in split(text))
    want = []
    for r in odd.collect():
        text = r.text or ""
        after = {1: "Z \nb", 10: "new" + text}.get(r.doc_id, text)
        want.append((r.doc_id, count(text), count(after), len(after)))
    assert got == sorted(want, key=str)
    assert token_counts.edited_counts(none, F.lit(None)).count() == 0


# quality classifier


def test_quality_classifier(spark, odd, none):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        text = words(rng, rng.randrange(20, 200))
        bad = i % 4 == 0
        rows.append((i, [text.upper() + "!!", " ".join(w + "###" for w in text.split()), " ".join([text.split()[0]] * 60)][i % 3] if bad else text, int(not bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality_classifier.train(df, df.filter("doc_id < 400").select("doc_id", "quality"))
    got = {r.doc_id: r.keep for r in quality_classifier.classify(df, model).collect()}
    assert sum(got[i] == (q == 1) for i, _, q in rows if i >= 400) / 200 > 0.95
    assert 0 < len(model.rules) < 200
    # the compiled column says what the rules say
    x = df.select("doc_id", *quality_classifier.statistics(F.col("text"))).select("doc_id", *quality_classifier.features()).toPandas().sort_values("doc_id")
    want = model.predict(x[quality_classifier.FEATURES].to_numpy(float))
    scores = [r.score for r in quality_classifier.classify(df, model).orderBy("doc_id").collect()]
    assert np.allclose(want, scores)
    kept = quality_classifier.keep_good(odd, model)
    assert kept.dtypes == odd.dtypes and kept.filter("doc_id IN (2, 3, 4)").count() == 0
    assert quality_classifier.classify(odd, model).count() == odd.count() and quality_classifier.classify(none, model).count() == 0
    blind = quality_classifier.train(df, none.select("doc_id", F.lit(1).alias("quality")))
    assert quality_classifier.keep_good(df, blind).count() == 600


# SimHash


def brute_groups(spark, df, distance):
    prints = [(r.id, r.th, np.frombuffer(r.fp, np.uint64)) for r in simhash.document_prints(df, "doc_id", "text", 9).collect() if r.fp]
    pairs = [(a[0], b[0]) for k, a in enumerate(prints) for b in prints[k + 1 :] if np.bitwise_count(a[2] ^ b[2]).sum() <= distance]
    return prints, pairs


def test_simhash(spark, odd, none):
    rng = random.Random(4)
    rows, copies = [], []
    for i in range(60):
        text = words(rng, rng.randrange(40, 300)).split()
        rows.append((10 * i, " ".join(text)))
        for k in range(i % 4):
            changed = [f"z{rng.randrange(10**6)}" if rng.random() < 0.04 else w for w in text] if k else text
            rows.append((10 * i + k + 1, " ".join(changed)))
            copies.append((10 * i, 10 * i + k + 1))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    _, pairs = brute_groups(spark, df, simhash.MAX_DISTANCE)
    assert np.mean([got[a].group_id == got[b].group_id for a, b in pairs]) > 0.95
    assert np.mean([got[a].group_id == got[b].group_id for a, b in copies]) > 0.95
    assert all(got[i].group_id // 10 == i // 10 for i in got)  # nothing else is joined
    assert all(r.keep == (r.doc_id == r.group_id) for r in got.values())
    out = simhash.near_duplicates(odd).collect()
    assert len(out) == len({(r.doc_id, r.text) for r in odd.collect()}) and all(r.keep for r in out if r.doc_id in (2, 3, 4, 9))
    stay = simhash.one_of_each_group(odd)
    assert stay.dtypes == odd.dtypes and stay.filter("doc_id = 7").count() == 1 and stay.filter("doc_id IN (2, 3, 4)").count() == 3
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_of_each_group(none).count() == 0
    with pytest.raises(ValueError):
        simhash.near_duplicates(df, blocks=7, block_bits=15)
    wide = {r.doc_id: r.group_id for r in simhash.near_duplicates(df, blocks=85, block_bits=26).collect()}  # as for 10^9 documents
    assert np.mean([wide[a] == wide[b] for a, b in pairs]) > 0.95


@pytest.mark.parametrize("n, most", [(10**5, 0.12), (10**8, 0.12), (10**10, 0.12)])
def test_blocks_of_larger_corpora_miss_no_more(n, most):
    rng, (blocks, bits) = np.random.default_rng(5), simhash.shape(n)
    heads = simhash.block_orders(blocks, bits)[:, :bits]
    missed = 0
    for _ in range(2000):
        differ = np.zeros(simhash.BITS, bool)
        differ[rng.choice(simhash.BITS, 80, replace=False)] = True
        missed += differ[heads].any(1).all()
    assert missed / 2000 < most and n / 2**bits <= 2 * simhash.CROWD and blocks < 256


def test_large_blocks_agree_with_all_pairs():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, (8, 9)).astype(np.uint64)
    fp = base[rng.integers(0, 8, 700)] ^ (np.uint64(1) << rng.integers(0, 64, (700, 9)).astype(np.uint64))
    keys = np.zeros(700, np.int64)

    def groups(edges):
        up = list(range(700))
        for a, b in edges:
            ra, rb = a, b
            while up[ra] != ra:
                ra = up[ra]
            while up[rb] != rb:
                rb = up[rb]
            up[max(ra, rb)] = min(ra, rb)
        out = []
        for i in range(700):
            while up[i] != i:
                i = up[i]
            out.append(i)
        return out

    small, large = simhash._edges_of(keys, fp, 40, large=10_000), simhash._edges_of(keys, fp, 40, large=10)
    assert groups(small) == groups(large) and len(small) == len(large) == 700 - 8


def close_and_far(n):
    """n pairs of fingerprints: some differ in just MAX_DISTANCE bits, some in one more; and one crowd of close ones."""
    rng = np.random.default_rng(6)
    bits = rng.integers(0, 2, (n, simhash.BITS)).astype(bool)
    other = bits.copy()
    for i in range(n):
        other[i, rng.choice(simhash.BITS, simhash.MAX_DISTANCE + i % 2, replace=False)] ^= True
    crowd = np.repeat(bits[:1], 300, 0) ^ (rng.random((300, simhash.BITS)) < 0.05)
    return np.packbits(np.concatenate([bits, other, crowd]), axis=1).view(np.uint64)


def test_all_pairs_at_the_threshold():
    fp = close_and_far(100)
    want = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if np.bitwise_count(fp[i] ^ fp[j]).sum() <= simhash.MAX_DISTANCE}
    assert all(((i, i + 100) in want) == (i % 2 == 0) for i in range(100)) and len(want) > 300 * 299 / 2
    for size in ({}, {"seeds": 7, "width": 64}, {"lanes": 1}, {"lanes": 9}):
        assert {(int(i), int(j)) for piece in simhash.close_pairs(fp, fp, simhash.MAX_DISTANCE, **size) for i, j in zip(*piece)} == want
    low, high = fp[:150], fp[150:]
    assert {(int(i), int(j) + 150) for piece in simhash.close_pairs(low, high, simhash.MAX_DISTANCE) for i, j in zip(*piece)} == {(i, j) for i, j in want if i < 150 <= j}
    edges = simhash.tile_edges(fp, None, simhash.MAX_DISTANCE)
    # 50 pairs and the crowd with the first fingerprint and its partner's pair: a forest has nodes less groups edges
    assert len(edges) == 50 + 300 and set(edges) <= want


def groups_of(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        up[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in up}


def test_simhash_leaves_no_link_out(spark):
    rng, rows = random.Random(7), []
    for i in range(0, 300, 3):
        text = [f"w{rng.randrange(10**9)}" for _ in range(200)]
        near = [f"x{k}" if k % 8 == 0 else w for k, w in enumerate(text)]
        rows += [(i, " ".join(text)), (i + 1, " ".join(near)), (i + 2, " ".join(near))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, pairs = brute_groups(spark, df, simhash.MAX_DISTANCE)
    want = groups_of(pairs)
    assert 250 > len(set(want.values())) and 50 < sum((i, i + 1) in set(pairs) for i in range(0, 300, 3))
    assert {r.doc_id: r.group_id for r in simhash.near_duplicates(df).collect()} == {i: want.get(i, i) for i, _ in rows}


def test_simhash_of_a_table_does_not_depend_on_its_size(spark, monkeypatch):
    """Not on the blocks that would suit a larger one, nor on the number of parts."""
    rng, rows = random.Random(9), []
    for i in range(0, 200, 2):
        text = [f"w{rng.randrange(10**9)}" for _ in range(200)]
        rows += [(i, " ".join(text)), (i + 1, " ".join(f"x{i}" if k % 8 == 0 else w for k, w in enumerate(text)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    groups = lambda: {r.doc_id: r.group_id for r in simhash.near_duplicates(df).collect()}
    want, fitting = groups(), simhash.shape
    monkeypatch.setattr(simhash, "shape", lambda n: fitting(10**10))
    assert groups() == want
    monkeypatch.setattr(simhash, "PART", 40)
    assert simhash.parts_of(200, 1) == 5 and groups() == want
    with pytest.raises(ValueError):
        simhash.near_duplicates(df, blocks=40)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (5, 5), (60, 2), (200, 201), (202, 201)]
    got = {r.u: r.v for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 60: 0, 101: 100, 201: 200, 202: 200}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# decontamination


def smith_waterman(a, b):
    last, best = [0] * (len(b) + 1), 0
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, last[j] + (2 if x == y else -1), last[j + 1] - 1, row[j] - 1))
        last, best = row, max(best, *row)
    return best


def test_alignment():
    rng = np.random.default_rng(1)
    items, passages = [rng.integers(2, 9, n) for n in (8, 12, 30, 9)], [rng.integers(2, 9, n) for n in (5, 40, 60, 9)]
    assert decontaminate.align(items, passages).tolist() == [smith_waterman(a, b) for a, b in zip(items, passages)]


def test_decontamination(spark, odd, none):
    rng = random.Random(6)
    items = [(i, words(rng, rng.randrange(15, 45))) for i in range(30)] + [(90, "too short"), (93, "w1x w2x w3x w4x w5x w6x w7x w1x"), (91, None), (92, "")]
    docs, want = [], set()
    for d in range(200):
        text = words(rng, rng.randrange(50, 400)).split()
        if d % 3 == 0:
            item = items[d % 30]
            copy = [x for w in item[1].split() for x in ([w] if rng.random() > 0.15 else rng.choice([[], [w, "new"], ["other"]]))] if d % 2 else item[1].split()
            at = rng.randrange(len(text))
            text[at:at] = copy
            want.add((d, item[0]))
        docs.append((d, " ".join(text)))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.benchmark_matches(df, bench).collect()}
    exact = {p for p in want if p[0] % 2 == 0}
    assert set(got) <= want and exact <= set(got) and len(got) >= 0.9 * len(want)
    assert all(got[p].score == 1.0 for p in exact)
    # brute force: every item with every document
    for d, text in docs[:12]:
        for i, item in items[:30]:
            score = smith_waterman(item.split(), text.split()) / (2 * len(item.split()))
            assert (score >= decontaminate.MIN_SCORE) == ((d, i) in got)
    clean = decontaminate.drop_contaminated(df, bench)
    assert {r.doc_id for r in clean.collect()} == set(range(200)) - {d for d, _ in got}
    assert decontaminate.drop_contaminated(odd, bench).dtypes == odd.dtypes and decontaminate.drop_contaminated(odd, bench).count() == odd.count()
    assert decontaminate.benchmark_matches(odd, bench).count() == 0 and decontaminate.benchmark_matches(none, bench).count() == 0
    assert decontaminate.benchmark_matches(df, bench.limit(0)).count() == 0 and decontaminate.drop_contaminated(df, bench.limit(0)).count() == 200


@pytest.mark.parametrize("edited", [0.2, 0.25, 0.33])
def test_decontamination_of_edited_copies(spark, edited):
    rng = random.Random(round(100 * edited))
    items = [words(rng, n, 10**9).split() for n in range(15, 60) for _ in range(8)]
    docs, want = [], set()
    for i in range(len(items)):  # one copy each: what the edits destroyed occurs nowhere
        copy = [words(rng, 1, 10**9) if rng.random() < edited else w for w in items[i]]
        docs.append((i, " ".join([words(rng, 50, 10**9), *copy, words(rng, 50, 10**9)])))
        if smith_waterman(items[i], copy) >= 2 * len(copy) * decontaminate.MIN_SCORE:
            want.add((i, i))
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.benchmark_matches(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert len(want) > 100 and got <= want and len(got) >= 0.98 * len(want)


def test_short_items_word_for_word(spark):
    items = [(1, "Alpha"), (2, "beta gamma"), (3, "one two three four five six seven"), (4, "One, two three four five six SEVEN"), (5, "...")]
    docs = [(1, "so alpha and beta gamma"), (2, "beta x gamma"), (3, "zero one two three four five six seven eight one two three four five six seven"), (4, "one two three four five six eight"), (5, "beta"), (6, "gamma")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.score, r.passage_from, r.passage_to) for r in decontaminate.benchmark_matches(df.coalesce(1), bench).collect())
    assert got == [(1, 1, 1.0, 1, 2), (1, 2, 1.0, 3, 5), (3, 3, 1.0, 1, 8), (3, 4, 1.0, 1, 8)]
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(df, bench).collect()) == [2, 4, 5, 6]


def test_repeated_rows_and_equal_passages(spark):
    item = "a b c d e f g h i j"
    docs = [(1, f"{item} x y z {item}")] * 2 + [(2, "nothing at all")]
    got = decontaminate.benchmark_matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item), (7, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.score, r.passage_from) for r in got] == [(1, 7, 1.0, 0)] * 4  # two rows, two items of one id, the first passage


def test_decontamination_by_slices(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, words(rng, 20)) for i in range(9)]
    df = spark.createDataFrame([(i, words(rng, 30) + " " + t) for i, t in items], "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "SLICE_WORDS", 50)
    got = decontaminate.benchmark_matches(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, i) for i in range(9)}


# PII


def test_pii(spark, odd, none):
    rng = random.Random(9)
    rows = []
    for i in range(60):
        card = "".join(rng.choice("0123456789") for _ in range(16))
        rows.append((i, f"{words(rng, 5)} pay {card} now. mail me.{i}@mail{i}.example.com, from {rng.randrange(256)}.{i}.7.9 call +1 ({100 + i}) 555-{1000 + i} key token = \"{rng.randbytes(20).hex()}\" in version 2.0"))
    rows += [(100, "pay 300.400.5.6 now"), (101, "plain text of 1999 and 3 parts, version 2.0.")]
    rows.append((102, f"seen {rng.randbytes(20).hex()} here"))
    got = pii.identifiers(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, {})[r.kind] = r
    assert all(set(by[i]) == {"card", "email", "ip", "phone", "secret"} for i in range(60))
    assert any(not by[i]["card"].seed for i in range(60))  # check digit wrong, found by its form
    assert set(by[100]) == {"ip"} and not by[100]["ip"].seed and set(by[102]) == {"secret"} and 101 not in by
    texts = dict(rows)
    assert all(texts[r.doc_id][r["from"] : r.to] == r.value for r in got)
    assert pii.identifiers(odd).count() == 0 and pii.identifiers(none).count() == 0


def test_pii_by_context_alone(spark):
    rng = random.Random(10)
    letters = lambda: "".join(rng.choice("abcdefghijkmnopqrstuvw") for _ in range(14))
    rows = []
    for i in range(40):
        rows.append((i, f"{words(rng, 4)} please call +1 ({100 + i}) 555-{1000 + i} soon {words(rng, 4)} password = \"{rng.randbytes(9).hex()}\" {words(rng, 3)} page {i} of {200 + i} theme = {letters()} ok"))
    forms = ["(020) 7946 0958", "555-123-4567", "0049/30/123456"]
    rows += [(100 + k, f"{words(rng, 4)} please call {form} soon {words(rng, 4)}") for k, form in enumerate(forms)]
    secret = letters()
    rows += [(200, f"password = {secret} ok"), (201, f"{words(rng, 3)} page A-77 of {letters()}"), (202, f"theme = {secret}")]
    got = {}
    for r in pii.identifiers(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.kind, r.value))
    assert all({k for k, _ in got[i]} == {"phone", "secret"} and len(got[i]) == 2 for i in range(40))
    assert [got.get(100 + k) for k in range(3)] == [[("phone", form)] for form in forms]
    assert got[200] == [("secret", secret)] and 201 not in got and 202 not in got


def brute_labels(found, rounds, min_score, min_support, unknown):
    """The rounds over the pattern-instance graph in plain Python."""
    edges, alone = {}, {}
    for f in found:
        some, form, left, two, right = f.value == f.instance, f.form, f.left, f.two, f.right
        own = []
        if some:
            own += [(form, False), (f"{left} {form} <", False), (f"> {form} {right}", False)]
            own += [(f"{left} <>", True)] * bool(left) + [(f"<> {right}", True)] * bool(right) + [(f"{left} <> {right}", True)] * bool(left and right)
        if two:
            own += [(f"{two} {form} <<", False), (f"{two} < <>", True)] + [(f"{two} < <> {right}", True)] * bool(right)
        for pattern, is_alone in own:
            edges.setdefault(pattern, set()).add(f.instance)
            alone[pattern] = is_alone
    edges = {p: i for p, i in edges.items() if len(i) >= min_support}
    seeds = {}
    for f in found:
        if f.seed is not None and seeds.get(f.instance, "ordinary") == "ordinary":
            seeds[f.instance] = f.seed
    labels = {i: (k, 1.0) for i, k in seeds.items()}
    for _ in range(rounds):
        taken = {}
        for p, members in edges.items():
            mass, n = {}, {}
            for i in members & set(labels):
                k, c = labels[i]
                mass[k], n[k] = mass.get(k, 0) + c, n.get(k, 0) + 1
            total = sum(mass.values()) + (unknown * (len(members) - sum(n.values())) if alone[p] else 0) + 1
            for k in mass:
                if mass[k] / total >= min_score and n[k] >= min_support:
                    for i in members:
                        taken.setdefault(i, {}).setdefault(k, []).append((mass[k] / total, alone[p]))
        new = {i: (k, 1.0) for i, k in seeds.items()}
        for i, kinds in taken.items():
            if i not in seeds:
                best = min((all(a for _, a in s) or k == "ordinary", -(1 - np.prod([1 - x for x, _ in s])), k) for k, s in kinds.items())
                new[i] = (best[2], -best[1])
        done = {i: (k, round(c, 3)) for i, (k, c) in new.items()} == {i: (k, round(c, 3)) for i, (k, c) in labels.items()}
        labels = new
        if done:
            break
    return labels


def test_pii_graph_against_plain_python(spark):
    found = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("doc_id").alias("id"), "text").filter("text IS NOT NULL")
    rows = [(r.id, *c) for r in found.collect() for c in pii.candidates(r.text)]
    made = [(i, a, b, v, v if re.search(r"[\d@]", v) else f"{two} {v}", pii.masked(v), left, two, right, seed) for i, a, b, v, left, two, right, seed in rows]
    df = spark.createDataFrame(made, "id long, `from` long, `to` long, value string, instance string, form string, left string, two string, right string, seed string")
    want = brute_labels(df.collect(), pii.ROUNDS, pii.MIN_SCORE, pii.MIN_SUPPORT, pii.UNKNOWN)
    got = {r.instance: (r.kind, r.confidence) for r in pii.label_instances(df).collect()}
    assert {i: k for i, (k, _) in got.items()} == {i: k for i, (k, _) in want.items()} and len(got) > 50
    assert all(abs(c - want[i][1]) < 1e-6 for i, (_, c) in got.items())
    # the query is these labels joined to the occurrences
    query = sorted((r.doc_id, r.kind, r.value, r["from"], r["to"]) for r in QUERIES["op6_pii"](spark, "/root/testdata/sf0.01").collect())
    assert query == sorted((i, want[x][0], v, a, b) for i, a, b, v, x, *_ in made if want.get(x, ("ordinary",))[0] != "ordinary")


# sharding


def brute_table(shards, slots):
    import hashlib

    prefer = {}
    for s in shards:
        d = hashlib.md5(s.encode()).digest()
        offset, skip = int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:], "big") % (slots - 1) + 1
        prefer[s] = [(offset + j * skip) % slots for j in range(slots)]
    owner = {}
    while len(owner) < slots:
        for k, s in enumerate(shards):
            free = next((x for x in prefer[s] if x not in owner), None)
            if free is not None:
                owner[free] = k
    return [owner[i] for i in range(slots)]


def test_sharding(spark, odd, none):
    import hashlib

    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, 101)
    assert table == brute_table(names, 101)
    sizes = np.bincount(table)
    assert sizes.max() - sizes.min() <= 1
    fewer = sharding.lookup_table(names[:-1], 101)
    assert sum(a != b for a, b in zip(table, fewer) if a != 6) < 30
    for r in sharding.place(odd, shards=names, slots=101).collect():
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard) == (slot, table[slot])
    assert sharding.place(odd).count() == odd.count() and sharding.place(none).count() == 0
    for name in ("slot", "shard"):
        with pytest.raises(ValueError):
            sharding.place(odd.withColumnRenamed("doc_id", name), name)
    for bad in ((names, 100), ([], 101), (["a", "a"], 101)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


# quality rules


def test_quality_rules(spark, odd, none):
    rows = [(i, f"Menu {i}\nown line {chr(97 + i)}\nmenu   1", "h" if i < 6 else None) for i in range(12)] + [(20, "menu 5", "h"), (21, "menu 5", "other"), (22, None, "h"), (23, "\n", "h"), (20, "menu 5", "h")]
    got = {r.doc_id: r for r in quality_rules.line_decisions(spark.createDataFrame(rows, "doc_id long, text string, source string"), max_docs=5).collect()}
    assert (got[0].n_lines, got[0].n_removed) == (3, 2) and got[0].keep
    assert got[20].n_removed == 1 and not got[20].keep and got[21].keep and got[22].keep and got[23].keep and got[23].kept_share == 1.0
    assert len(got) == 16
    assert quality_rules.line_decisions(odd).count() == len({(r.doc_id, r.text, r.source) for r in odd.collect()})
    assert quality_rules.line_decisions(none).count() == 0


def test_common_lines_are_removed(spark, odd, none):
    rows = [(i, f"Menu {i}\n\nOwn  line {chr(97 + i)}\nmenu   1\nlast", "h", 1) for i in range(6)]
    rows += [(20, "menu 5", "h", 1), (20, "menu 5", "h", 1), (21, "menu 5", "other", 1), (22, None, "h", None), (23, "\n", "h", 1), (24, "plain text", None, 1), (25, "last\nthat is long enough", "h", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    bits = {r.doc_id: (r.line_bits, r.keep) for r in quality_rules.line_decisions(df, max_docs=5).collect()}
    assert bits[0] == ("01100", True) and bits[20] == ("0", False) and bits[21] == ("1", True) and bits[22] == (None, True)
    assert bits[23] == ("11", True) and bits[24] == ("1", True) and bits[25] == ("01", True) and len(bits) == 12
    out = quality_rules.drop_common_lines(df, max_docs=5)
    want = [(i, f"\nOwn  line {chr(97 + i)}", "h", 12) for i in range(6)] + [(21, "menu 5", "other", 6), (22, None, "h", None), (23, "\n", "h", 1), (24, "plain text", None, 10), (25, "that is long enough", "h", 19)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str) and out.dtypes == df.dtypes
    stay = quality_rules.drop_common_lines(odd)
    assert stay.dtypes == odd.dtypes and stay.count() == odd.count() and quality_rules.drop_common_lines(none).count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = {r.doc_id: (r.n_removed, r.line_bits.count("0")) for r in quality_rules.line_decisions(docs, max_docs=1).collect()}
    assert all(a == b for a, b in counts.values()) and any(a for a, _ in counts.values())


# BPE


def tiktoken_encoding():
    """The vocabulary with a splitting pattern of its own, apart from pretokens."""
    import base64

    import tiktoken

    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("room", [24 << 20, 3000, 0])
def test_bpe(spark, odd, none, room):
    plain = tiktoken_encoding()
    docs = odd.select("doc_id", "text").unionByName(spark.read.parquet(f"{SF}/documents.parquet").select(F.expr("doc_id + 1000").alias("doc_id"), "text"))
    encoded = bpe.encode_corpus(docs, table_bytes=room)
    got = sorted(((r.doc_id, r.token_ids) for r in encoded.collect()), key=str)
    want = sorted(((r.doc_id, None if r.text is None else plain.encode_ordinary(r.text)) for r in docs.collect()), key=str)
    assert got == want and encoded.filter("NOT round_trip").count() == 0
    back = sorted(((r.doc_id, r.text) for r in bpe.decode_corpus(encoded).collect()), key=str)
    assert back == sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    assert bpe.encode_corpus(none).count() == 0


def test_decode_unknown_ids(spark):
    rows = spark.createDataFrame([(1, [0, 60_000]), (2, [0, None]), (3, None), (4, []), (5, [31373])], "doc_id long, token_ids array<int>")
    assert {r.doc_id: r.text for r in bpe.decode_corpus(rows).collect()} == {1: None, 2: None, 3: None, 4: "", 5: "hello"}
