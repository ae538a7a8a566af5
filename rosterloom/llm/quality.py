"""Quality classifier: a sparse rule ensemble compiled to Spark column expressions.

1. Statistics of the whole text are Spark columns: shares of capitals, symbols and digits, lengths,
   repetition of words and lines.
2. On a bounded sample of labelled rows (``SAMPLE``, the rows with the least hashes of their
   ids), shallow trees are grown on bootstrap samples with random feature subsets.  Every path
   from a root to a node is a conjunctive rule.
3. A lasso logistic regression over all rules keeps few of them; its penalty is the one with
   the least loss on rows held back from the sample.
4. The kept rules become comparisons of columns, the score a logistic function of their sum.

Labels, language, source and document id are never inputs.  Null texts count as empty; the
statistics of an empty text are zeros, so it has a score like any other.  A document with several
labels counts as good if at least half of them say so; null labels are ignored.  Repeated
documents stay rows of the result.  Without any label, or with labels of one class only, the
score is that class's smoothed share.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm.common import read

#: At most so many labelled rows are fitted on.
SAMPLE = 20_000
TREES, DEPTH, LEAST_LEAF = 24, 3, 20
CUTS = 32
PENALTIES = (0.03, 0.01, 0.003, 0.001, 0.0003)
GOOD = 0.7
SEED = 7

STATISTICS = ["log_chars", "log_words", "word_length", "distinct_words", "longest_word", "upper",
              "symbols", "digits", "stops", "log_lines", "distinct_lines", "line_length"]


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, plus one double column for each statistic."""
    t = F.coalesce(F.col(text), F.lit(""))
    split = docs.withColumns({
        "__n": F.char_length(t),
        "__words": F.filter(F.split(t, r"\s+"), lambda w: w != ""),
        "__lines": F.split(t, "\n"),
        "__upper": F.char_length(F.regexp_replace(t, r"[^\p{Lu}]+", "")),
        "__symbols": F.char_length(F.regexp_replace(
            t, r"[\p{L}\p{M}\p{N}\s.,;:'?()-]+", "")),
        "__digits": F.char_length(F.regexp_replace(t, r"[^0-9]+", "")),
        "__stops": F.char_length(F.regexp_replace(t, r"[^.,;:?]+", "")),
    })
    chars = F.greatest("__n", F.lit(1))
    words = F.greatest(F.size("__words"), F.lit(1))
    lines = F.size("__lines")
    columns = {
        "log_chars": F.log1p("__n"),
        "log_words": F.log1p(F.size("__words")),
        "word_length": F.col("__n") / words,
        "distinct_words": F.size(F.array_distinct("__words")) / words,
        "longest_word": F.log1p(F.coalesce(
            F.array_max(F.transform("__words", F.char_length)), F.lit(0))),
        "upper": F.col("__upper") / chars,
        "symbols": F.col("__symbols") / chars,
        "digits": F.col("__digits") / chars,
        "stops": F.col("__stops") / words,
        "log_lines": F.log1p(lines),
        "distinct_lines": F.size(F.array_distinct("__lines")) / lines,
        "line_length": F.log1p(F.col("__n") / lines),
    }
    kept = [c for c in docs.columns if c != text]
    return split.select(*kept, *[columns[c].cast("double").alias(f"stat_{c}")
                                 for c in STATISTICS])


# ------------------------------------------------------------------ rules

#: A rule is a set of conditions (statistic, "<=" or ">", bound).
Rule = tuple[tuple[int, str, float], ...]


def _paths(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray],
           draw: np.random.Generator) -> set[Rule]:
    """Conjunctions along all paths of one tree grown on a bootstrap sample."""
    rules: set[Rule] = set()

    def grow(rows: np.ndarray, path: Rule, depth: int) -> None:
        if path:
            rules.add(path)
        if depth == DEPTH or len(rows) < 2 * LEAST_LEAF:
            return
        total, good = len(rows), y[rows].sum()
        if good in (0, total):
            return
        best = (1e-9, None)
        impurity = good * (total - good) / total
        chosen = draw.choice(x.shape[1], size=max(2, x.shape[1] // 2), replace=False)
        for f in chosen.tolist():
            for bound in cuts[f].tolist():
                low = x[rows, f] <= bound
                n = int(low.sum())
                if n < LEAST_LEAF or total - n < LEAST_LEAF:
                    continue
                g = y[rows][low].sum()
                left = g * (n - g) / n
                right = (good - g) * (total - n - good + g) / (total - n)
                gain = impurity - left - right
                if gain > best[0]:
                    best = (gain, (f, bound))
        if best[1] is None:
            return
        f, bound = best[1]
        low = x[rows, f] <= bound
        grow(rows[low], _joined(path, (f, "<=", bound)), depth + 1)
        grow(rows[~low], _joined(path, (f, ">", bound)), depth + 1)

    grow(draw.integers(0, len(x), len(x)), (), 0)
    return rules


def _joined(path: Rule, condition: tuple[int, str, float]) -> Rule:
    """The path with one more condition; of two on one side the tighter stays."""
    f, sign, bound = condition
    pick = min if sign == "<=" else max
    for other in path:
        if other[:2] == (f, sign):
            bound = pick(bound, other[2])
    return tuple(sorted([c for c in path if c[:2] != (f, sign)] + [(f, sign, bound)]))


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    parts = [x[:, f] <= bound if sign == "<=" else x[:, f] > bound for f, sign, bound in rule]
    return np.logical_and.reduce(parts)


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, weights: np.ndarray,
           bias: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty, by accelerated proximal gradient steps."""
    n = len(y)
    norm = np.linalg.norm(z, 2) ** 2 / (4 * n) + 0.25
    step = 1 / norm
    w, b, v, c, t = weights.copy(), bias, weights.copy(), bias, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ v + c, -30, 30)))
        g = z.T @ (p - y) / n
        w_new = v - step * g
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - step * penalty, 0)
        b_new = c - step * float((p - y).mean())
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = w_new + (t - 1) / t_new * (w_new - w)
        c = b_new + (t - 1) / t_new * (b_new - b)
        moved = np.abs(w_new - w).max(initial=0)
        w, b, t = w_new, b_new, t_new
        if moved < 1e-6:
            break
    return w, b


class Ensemble:
    """Weighted conjunctive rules and a bias."""

    def __init__(self, rules: list[Rule], weights: list[float], bias: float) -> None:
        self.rules, self.weights, self.bias = rules, weights, bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for rule, weight in zip(self.rules, self.weights):
            total += weight * _holds(rule, x)
        return 1 / (1 + np.exp(-total))

    def column(self) -> Column:
        """The score of a row of :func:`statistics`."""
        def holds(rule: Rule) -> Column:
            return reduce(lambda a, b: a & b, [
                F.col(f"stat_{STATISTICS[f]}") <= F.lit(bound) if sign == "<="
                else F.col(f"stat_{STATISTICS[f]}") > F.lit(bound) for f, sign, bound in rule])
        total = reduce(lambda a, b: a + b, [
            F.when(holds(r), F.lit(w)).otherwise(F.lit(0.0))
            for r, w in zip(self.rules, self.weights)], F.lit(float(self.bias)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """The ensemble for statistics x and labels y (0 or 1)."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Ensemble([], [], float(np.log(share / (1 - share))))
    draw = np.random.default_rng(SEED)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 2)[1:-1]))
            for f in range(x.shape[1])]
    rules: set[Rule] = set()
    for _ in range(TREES):
        rules |= _paths(x, y, cuts, draw)
    ordered = sorted(rules)
    z = np.column_stack([_holds(r, x) for r in ordered]) if ordered else np.zeros((len(y), 0))
    # Rules that mark the same rows count once; the shortest of them stays.
    first: dict[bytes, int] = {}
    for i in sorted(range(len(ordered)), key=lambda i: (len(ordered[i]), i)):
        first.setdefault(np.packbits(z[:, i]).tobytes(), i)
    chosen = sorted(first.values())
    ordered, z = [ordered[i] for i in chosen], z[:, chosen].astype(np.float64)
    back = draw.random(len(y)) < 0.2
    if back.sum() < 20 or y[~back].min() == y[~back].max():
        back = np.zeros(len(y), bool)
    weights, bias = np.zeros(z.shape[1]), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    best = (np.inf, PENALTIES[1])
    for penalty in PENALTIES if back.any() else ():
        weights, bias = _lasso(z[~back], y[~back], penalty, weights, bias)
        p = np.clip(1 / (1 + np.exp(-(z[back] @ weights + bias))), 1e-6, 1 - 1e-6)
        loss = -float((y[back] * np.log(p) + (1 - y[back]) * np.log(1 - p)).mean())
        best = min(best, (loss, penalty))
    weights, bias = _lasso(z, y, best[1], weights * 0, bias)
    kept = np.nonzero(weights)[0].tolist()
    return Ensemble([ordered[i] for i in kept], weights[kept].tolist(), float(bias))


# ------------------------------------------------------------------ over tables

def held_out(id_column: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2,
                      F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
          label: str = "quality", sample: int = SAMPLE) -> Ensemble:
    """The ensemble fitted on at most ``sample`` labelled rows outside the held-out quarter."""
    chosen = (labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull()
                           & ~held_out(id_column))
              .groupBy(id_column).agg((F.avg(label) >= 0.5).cast("double").alias("__y"))
              .orderBy(F.xxhash64(id_column), id_column).limit(sample))
    rows = statistics(docs.select(id_column, text).join(F.broadcast(chosen), id_column), text)
    # In one order, however the rows were spread: the same tables give the same ensemble.
    table = rows.dropDuplicates([id_column]).toPandas().sort_values(id_column)
    return fit(table[[f"stat_{c}" for c in STATISTICS]].to_numpy(np.float64),
               table["__y"].to_numpy(np.float64))


def scored(docs: DataFrame, model: Ensemble, text: str = "text") -> DataFrame:
    """``docs`` without its text, plus ``score``."""
    found = statistics(docs, text)
    kept = [c for c in docs.columns if c != text]
    return found.select(*kept, model.column().alias("score"))


def good_documents(docs: DataFrame, labels: DataFrame, text: str = "text",
                   least: float = GOOD) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``."""
    model = learn(docs, labels, text=text)
    marked = docs.withColumn("__text", F.col(text))
    return (statistics(marked, "__text").where(model.column() >= least)
            .select(*docs.columns))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    model = learn(docs, read(spark, folder, "labels", "doc_id", "quality"))
    return scored(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"))
