"""The corpus pipeline against plain Python and against its stages done one by one, and on odd inputs."""

import corpus_pipeline as p
import numpy as np
import regex
import xxhash
from pyspark.sql import functions as F
from test_corpus_operators import first_occurrences, smith_waterman, tiktoken_encoding

from millrace.llm import decontaminate, quality_classifier, simhash

SF = "/root/testdata/sf0.001"


def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for _, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        assert docs.columns == columns and docs.filter("n_chars <> length(text)").count() == 0
        counts.append(len(rows))
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    want = {r.doc_id: r.token_ids for r in p.STAGES[-1][1](spark, docs, SF).collect()}
    got = {r.doc_id: r.token_ids for r in p.run(spark, SF).collect()}
    assert got == want
    left = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0").select("doc_id")
    assert left.filter(F.col("doc_id").isin(list(got))).count() <= 1


def test_stages_keep_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "word " * 30_000, "en", "s", 150_000), (None, "a fine line of text here", None, None, 24)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes
        out.collect()
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert p.STAGES[-1][1](spark, docs, SF).count() == 4


# the whole pipeline in plain Python


def kept_by_rules(text, model):
    if text is None or not text.strip(" \t\r\n"):
        return False
    parts, rows, n = regex.sub("[ \t\r\n]+", " ", text).strip(" ").split(" "), text.split("\n"), max(len(text), 1)
    count = lambda pattern: len(regex.findall(pattern, text))
    found = [
        np.log1p(len(text)), n / len(parts), len(set(parts)) / len(parts), sum(a == b for a, b in zip(parts, parts[1:])) / len(parts), count(r"\p{Lu}") / n,
        count(r"[#$%&*|<>{}=~^\\_!?+@\[\]]") / n, count("[0-9]") / n, count("[.,;:]") / len(parts), n / len(rows), len(set(rows)) / len(rows),
    ]
    z = model.intercept + sum(weight for rule, weight in model.rules if all((found[f] > cut) == above for f, above, cut in rule))
    return 1 / (1 + np.exp(-z)) >= model.cut


def without_earlier_lines(texts):
    out = {}
    for i, bits in first_occurrences(texts.items()).items():
        text = texts[i]
        left = text if text is None or all(bits) else "\n".join(x for x, keep in zip(text.split("\n"), bits) if keep)
        if left is None or left.strip(" \n\t\r") or not text.strip(" \n\t\r"):
            out[i] = left
    return out


def lower_words(text):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def first_of_groups(texts):
    prints = {}
    for i, text in sorted(texts.items()):
        hashes = np.array(sorted({xxhash.xxh64_intdigest(w.encode(), seed=42) for w in lower_words(text)}), np.uint64)
        if len(hashes):
            lanes = [simhash._mix(hashes + np.uint64((k * 0x9E3779B97F4A7C15) % 2**64)) for k in range(1, 10)]
            votes = np.concatenate([((x[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).sum(0) for x in lanes])
            prints[i] = 2 * votes > len(hashes)
    group = {i: i for i in texts}
    for i in prints:
        for j in prints:
            if j < i and group[i] != group[j] and (prints[i] != prints[j]).sum() <= simhash.MAX_DISTANCE:
                a, b = sorted((group[i], group[j]))
                group = {k: a if g == b else g for k, g in group.items()}
    return {i: text for i, text in texts.items() if group[i] == i}


def test_near_duplicates_leave_no_link_out(spark):
    """Pairs of texts of which an eighth differs are near the threshold; each pair is on its own, so no third text connects them."""
    rng, texts = np.random.default_rng(8), {}
    for i in range(0, 240, 2):
        words = [f"w{x}" for x in rng.integers(0, 10**9, 200)]
        texts[i], texts[i + 1] = " ".join(words), " ".join(f"z{x}" if x % 8 == i % 8 else w for x, w in enumerate(words))
    docs = spark.createDataFrame([(i, text, "en", "s", len(text)) for i, text in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    want = set(first_of_groups(texts))
    assert 130 < len(want) < 220
    assert {r.doc_id for r in p.near_duplicates(spark, docs, SF).collect()} == want


def holds_item(text, items):
    own = lower_words(text)
    for item in items:
        n = len(item)
        if n >= decontaminate.MIN_WORDS and sum(w in set(item) for w in own) >= n / 2 and smith_waterman(item, own) >= n:
            return True
        if 0 < n < decontaminate.MIN_WORDS and any(own[k : k + n] == item for k in range(len(own))):
            return True
    return False


def test_run_against_plain_python(spark):
    tables = {name: spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels", "benchmark")}
    model = quality_classifier.train(tables["documents"], tables["labels"])
    texts = {r.doc_id: r.text for r in tables["documents"].collect() if kept_by_rules(r.text, model)}
    steps = [len(texts)]
    for step in (without_earlier_lines, first_of_groups):
        texts = step(texts)
        steps.append(len(texts))
    items = [lower_words(r.text) for r in tables["benchmark"].collect()]
    texts = {i: text for i, text in texts.items() if not holds_item(text, items)}
    assert 200 > steps[0] > steps[1] >= steps[2] > len(texts) > 50
    plain = tiktoken_encoding()
    got = {r.doc_id: r.token_ids for r in p.run(spark, SF).collect()}
    assert got == {i: plain.encode_ordinary(text) for i, text in texts.items()}
