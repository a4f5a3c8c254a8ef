"""Quality classifier: a sparse ensemble of rules over document statistics.

Shallow trees are grown on bootstrap samples of labelled documents; every path from a root is a
conjunctive rule. An L1-penalised logistic regression over the rules keeps few of them, and those
compile to one Spark column expression, so scoring is a single narrow pass without Python.

The fit uses at most `fit_rows` labelled documents, chosen by hash of their id, and each tree a bootstrap
sample of at most `tree_rows` of each class; only statistics reach the driver. Everything else sees
every document.

Defined results
---------------
* Null or blank text: score 0.0, rejected.
* No usable labels, or labels of one class only: the score is the share of good labels (1.0
  without any), so all written documents stand or fall together.
* Several labels of one id: the lowest counts; null labels are ignored.
* The empty table gives no rows; long texts are read whole. Cuts of equal gain: the middle one.
* Each row is scored on its own, so repeated rows get equal scores; other columns are kept or
  ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table

#: Bound of the labelled sample, trees, their depth, least rows of a leaf, most rows of each class in a tree's bootstrap sample.
FIT_ROWS, TREES, DEPTH, LEAF, TREE_ROWS = 6000, 40, 3, 15, 1000

FEATURES = ["log_chars", "word_chars", "distinct_words", "stutter", "upper", "symbols", "digits", "stops", "line_chars", "distinct_lines"]


def statistics(text: Column) -> list[Column]:
    """Two steps of columns: the document's counts, each read once, and FEATURES over them."""
    flat = F.regexp_replace(text, "[ \t\r\n]+", " ")
    return [
        F.length(text).cast("double").alias("f_chars"),
        F.split(F.trim(flat), " ").alias("f_words"),
        F.split(text, "\n", -1).alias("f_lines"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("f_upper"),
        F.regexp_count(text, F.lit(r"[#$%&*|<>{}=~^\\_!?+@\[\]]")).alias("f_symbols"),
        F.regexp_count(text, F.lit("[0-9]")).alias("f_digits"),
        F.regexp_count(text, F.lit(r"[.,;:]")).alias("f_stops"),
    ]


def features() -> list[Column]:
    words, chars, lines = F.size("f_words"), F.greatest(F.col("f_chars"), F.lit(1.0)), F.size("f_lines")
    stutter = F.size(F.filter("f_words", lambda w, i: w == F.get("f_words", i - 1)))
    return [
        F.log1p("f_chars").alias("log_chars"), (chars / words).alias("word_chars"), (F.size(F.array_distinct("f_words")) / words).alias("distinct_words"), (stutter / words).alias("stutter"),
        (F.col("f_upper") / chars).alias("upper"), (F.col("f_symbols") / chars).alias("symbols"), (F.col("f_digits") / chars).alias("digits"), (F.col("f_stops") / words).alias("stops"),
        (chars / lines).alias("line_chars"), (F.size(F.array_distinct("f_lines")) / lines).alias("distinct_lines"),
    ]


Rule = tuple[tuple[int, bool, float], ...]


def _grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, path: Rule, rules: set[Rule]) -> None:
    if path:
        rules.add(path)
    if depth == 0 or len(y) < 2 * LEAF or y.min() == y.max():
        return
    best = None
    for f in rng.choice(x.shape[1], min(4, x.shape[1]), replace=False):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, 25))):
            right = x[:, f] > cut
            n = right.sum()
            if LEAF <= n <= len(y) - LEAF:
                p, q = y[right].mean(), y[~right].mean()
                impurity = n * p * (1 - p) + (len(y) - n) * q * (1 - q)
                if best is None or impurity < best[0]:
                    best = (impurity, int(f), float(cut), right)
    if best:
        _, f, cut, right = best
        for above, rows in ((True, right), (False, ~right)):
            _grow(x[rows], y[rows], rng, depth - 1, (*path, (f, above, cut)), rules)


def _lasso(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """L1-penalised logistic weights by accelerated proximal gradient; the intercept is free."""
    n, m = a.shape
    w, b = np.zeros(m), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    rate = 1 / (0.25 * (np.linalg.norm(a, 2) ** 2 / n + 1))
    vw, vb, t = w, b, 1.0
    for _ in range(steps):
        err = 1 / (1 + np.exp(-(a @ vw + vb))) - y
        step = vw - rate * (a.T @ err) / n
        new, nb = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0), vb - rate * err.mean()
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = new + (t - 1) / u * (new - w), nb + (t - 1) / u * (nb - b)
        w, b, t = new, nb, u
    return b, w


@dataclass(frozen=True)
class RuleModel:
    """score = logistic(intercept + sum of the weights of the rules that hold); keep at `cut`."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]
    cut: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            z += weight * _holds(x, rule)
        return 1 / (1 + np.exp(-z))

    def score(self) -> Column:
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            held = None
            for f, above, cut in rule:
                one = F.col(FEATURES[f]) > cut if above else F.col(FEATURES[f]) <= cut
                held = one if held is None else held & one
            z = z + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    held = np.ones(len(x), bool)
    for f, above, cut in rule:
        held &= (x[:, f] > cut) == above
    return held


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7, tree_rows: int = TREE_ROWS) -> RuleModel:
    """Trees and lasso on four fifths of the rows; penalty and cut are chosen on the rest."""
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 1.0
        return RuleModel(float(np.log((share + 1e-9) / (1 - share + 1e-9))), (), 0.5)
    rng = np.random.default_rng(seed)
    held = np.arange(len(y)) % 5 == 4
    if y[held].min() == y[held].max() or len(y) < 50:
        held[:] = False
    tx, ty = x[~held], y[~held]
    vx, vy = (x[held], y[held]) if held.any() else (tx, ty)
    rules: set[Rule] = set()
    good, bad = np.flatnonzero(ty == 1), np.flatnonzero(ty == 0)
    for _ in range(TREES):  # balanced bootstrap samples
        k = min(tree_rows, max(len(good), len(bad)))
        rows = np.concatenate([rng.choice(good, k), rng.choice(bad, k)])
        _grow(tx[rows], ty[rows], rng, DEPTH, (), rules)
    ordered = sorted(r for r in rules if 0.002 < _holds(tx, r).mean() < 0.998) or sorted(rules)
    if not ordered:
        return RuleModel(float(np.log((ty.mean() + 1e-9) / (1 - ty.mean() + 1e-9))), (), 0.5)
    a = np.stack([_holds(tx, r) for r in ordered], 1).astype(float)
    spread = a.std(0) + 1e-9
    best = None
    for penalty in (0.03, 0.01, 0.003, 0.001):
        b, w = _lasso((a - a.mean(0)) / spread, ty.astype(float), penalty)
        w = w / spread
        b -= float(a.mean(0) @ w)
        model = RuleModel(b, tuple((r, float(v)) for r, v in zip(ordered, w) if abs(v) > 1e-6), 0.5)
        p = np.clip(model.predict(vx), 1e-6, 1 - 1e-6)
        loss = -(vy * np.log(p) + (1 - vy) * np.log(1 - p)).mean() + 1e-4 * len(model.rules)
        if best is None or loss < best[0]:
            best = (loss, model, p)
    _, model, p = best
    cuts = np.linspace(0.05, 0.95, 19)
    gain = [((p >= c) & (vy == 1)).sum() / (vy == 1).sum() + ((p < c) & (vy == 0)).sum() / (vy == 0).sum() for c in cuts]
    top = cuts[np.isclose(gain, max(gain))]
    return RuleModel(model.intercept, model.rules, float(top[len(top) // 2]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS, tree_rows: int = TREE_ROWS) -> RuleModel:
    """Fit on at most fit_rows labelled documents, the first by hash of their id."""
    named = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).filter("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.min("y").alias("y"))
    sample = named.orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")  # fit_rows bounds the broadcast
    rows = rows.filter("trim(text) <> ''").select("id", "y", *statistics(F.col("text"))).select("id", "y", *features()).toPandas().sort_values(["id", *FEATURES])
    rows = rows.drop_duplicates("id").sample(frac=1, random_state=1) if len(rows) else rows
    return fit(rows[FEATURES].to_numpy(float), rows["y"].to_numpy(float), tree_rows=tree_rows)


def _scored(docs: DataFrame, model: RuleModel, text_col: str) -> DataFrame:
    """(_row, _score, _keep)"""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text_col).alias("_text"))
    blank = F.coalesce(F.trim(F.regexp_replace("_text", "[\t\r\n]", " ")) == "", F.lit(True))
    counted = row.select("_row", blank.alias("_blank"), *statistics(F.col("_text")))
    scored = counted.select("_row", "_blank", *features()).select("_row", F.when(F.col("_blank"), F.lit(0.0)).otherwise(model.score()).alias("_score"), "_blank")
    return scored.select("_row", "_score", (~F.col("_blank") & (F.col("_score") >= model.cut)).alias("_keep"))


def classify(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, keep) of each row."""
    return _scored(docs.select(id_col, text_col), model, text_col).select(F.col(f"_row.{id_col}").alias(id_col), F.col("_score").alias("score"), F.col("_keep").alias("keep"))


def keep_good(docs: DataFrame, model: RuleModel, text_col: str = "text") -> DataFrame:
    """The rows that are kept, with all their columns."""
    # a filter would be pushed below the statistics, with a copy of them for every rule; a generator is not
    kept = _scored(docs, model, text_col).select(F.explode(F.when(F.col("_keep"), F.array("_row"))).alias("_row"))
    return kept.select("_row.*")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify(docs, train(docs, table(spark, sf_dir, "labels")))


def op4_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics that the rules read, which SQL can say, unlike the fit."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", *statistics(F.col("text"))).select("doc_id", *features())


SQL = r"""
WITH parts AS (
  SELECT doc_id, text, greatest(length(text), 1)::DOUBLE AS chars, string_split(trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g'), ' '), ' ') AS words, string_split(text, chr(10)) AS lines FROM documents
), counted AS (
  SELECT *, len(words)::DOUBLE AS n, len(lines)::DOUBLE AS m, len([i FOR i IN range(2, len(words) + 1) IF words[i] = words[i - 1]]) AS twice FROM parts
)
SELECT doc_id, ln(1 + length(text)::DOUBLE) AS log_chars, chars / n AS word_chars, len(list_distinct(words)) / n AS distinct_words, twice / n AS stutter,
       len(regexp_extract_all(text, '\p{Lu}')) / chars AS upper, len(regexp_extract_all(text, '[#$%&*|<>{}=~^\\_!?+@\[\]]')) / chars AS symbols,
       len(regexp_extract_all(text, '[0-9]')) / chars AS digits, len(regexp_extract_all(text, '[.,;:]')) / n AS stops, chars / m AS line_chars, len(list_distinct(lines)) / m AS distinct_lines
FROM counted
"""

QUERIES = {"op4_quality_classifier": op4_quality_classifier, "op4_statistics": op4_statistics}
ORACLE = {"op4_statistics": SQL}
