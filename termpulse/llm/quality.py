"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of a text are column expressions. A few boosted shallow trees are grown on them; every path from a root to a
node is a rule, a conjunction of bounds. A logistic model with a lasso penalty weighs the rules, most of which get no
weight, and those left are compiled into one column expression. So a text is scored where it stands, without Python and
without a shuffle.

The model is fitted on at most ``SAMPLE`` labelled rows, chosen by a hash of their id: that many rows of some twenty numbers
fix the few weights, and reach the driver whatever the size of the input. Statistics and scores cover every row.

Null text: empty, scored like any text. Null labels: not learned from. Different labels of a doc_id: each counts once; of rows
that share a doc_id one is learned from, and all are scored. Without labels every score is 0.5 (kept); with labels of one kind every score is that kind's smoothed share. Empty table: no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpulse.functions.common import let
from termpulse.llm import common

#: Labelled rows that the model is fitted on, at most.
SAMPLE = 20_000
#: Trees, their depth, bins of a statistic, least rows of a leaf, step of the boosting, penalty of the lasso.
TREES, DEPTH, BINS, LEAF, STEP, PENALTY = 30, 3, 32, 8, 0.3, 0.001


# ---- statistics


STATISTICS = tuple(
    "log_chars log_words word_length upper letters digits sentence_marks shouts bars odd_signs doubled_signs different_words "
    "repeated_words log_lines different_lines line_length".split()
)


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def _count(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that match ``pattern``."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def statistics(text: Column, prefix: str = "") -> Column:
    """A struct of the statistics of a text, all doubles; ``prefix`` stands before their names."""

    def of(t: Column, words: Column, lines: Column) -> Column:
        n, n_words, n_lines = F.length(t), F.size(words), F.size(lines)
        again = F.size(F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, i - 1))))
        found = (
            F.log1p(n),
            F.log1p(n_words),
            _share(n, n_words),
            _share(_count(t, r"\p{Lu}+"), n),
            _share(_count(t, r"\p{L}+"), n),
            _share(_count(t, r"\p{N}+"), n),
            _share(_count(t, r"[.,;:?]+"), n_words),
            _share(_count(t, r"!+"), n_words),
            _share(_count(t, r"[|/\\<>{}\[\]_=~^]+"), n_words),
            _share(_count(t, r"[#&*$%@+]+"), n_words),
            _share(_count(t, r"([^\p{L}\p{N}\s])\1+"), n_words),
            _share(F.size(F.array_distinct(words)), n_words),
            _share(again, n_words),
            F.log1p(n_lines),
            _share(F.size(F.array_distinct(lines)), n_lines),
            F.log1p(_share(n, n_lines)),
        )
        return F.struct(*[c.cast("double").alias(f"{prefix}{name}") for c, name in zip(found, STATISTICS, strict=True)])

    # each of the three is worked out once
    return let(
        F.coalesce(text, F.lit("")),
        lambda t: let(
            F.array_remove(F.split(t, rf"{common.SPACE}+"), ""), lambda words: let(F.array_remove(F.split(t, r"\n"), ""), lambda lines: of(t, words, lines))
        ),
    )


def measured(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), prefix: str = "") -> DataFrame:
    """``keep`` and the statistics of each row, as columns that are worked out once however often they are used."""
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(statistics(F.col("text"), prefix))))


# ---- rules


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is it above the bound, bound)."""

    bounds: tuple[tuple[str, bool, float], ...]

    def column(self, prefix: str = "") -> Column:
        out = F.lit(True)
        for name, above, bound in self.bounds:
            own = F.col(f"{prefix}{name}")
            out = out & (own > bound if above else own <= bound)
        return out

    def holds(self, values: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
        out = np.ones(len(values), dtype=bool)
        for name, above, bound in self.bounds:
            own = values[:, names.index(name)]
            out &= own > bound if above else own <= bound
        return out


@dataclass(frozen=True)
class Model:
    """Intercept and weighted rules."""

    intercept: float
    rules: tuple[tuple[float, Rule], ...] = ()

    def score(self, prefix: str = "") -> Column:
        """Score from the columns of ``measured``, named with ``prefix``: 0 to 1."""
        total = F.lit(self.intercept)
        for weight, rule in self.rules:
            total = total + F.when(rule.column(prefix), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def grow(binned: np.ndarray, edges: list[np.ndarray], names: tuple[str, ...], y: np.ndarray) -> list[Rule]:
    """Rules of all paths of boosted trees on log loss."""
    total, rules = np.zeros(len(y)), {}

    def split(rows: np.ndarray, path: tuple, depth: int, g: np.ndarray, h: np.ndarray) -> None:
        if path:
            rules.setdefault(Rule(path), None)
        best = (1e-6, -1, -1)
        if depth < DEPTH and len(rows) >= 2 * LEAF:
            whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
            for f in range(binned.shape[1]):
                own = binned[rows, f]
                n = np.cumsum(np.bincount(own, minlength=BINS + 1))
                gs = np.cumsum(np.bincount(own, weights=g[rows], minlength=BINS + 1))
                hs = np.cumsum(np.bincount(own, weights=h[rows], minlength=BINS + 1))
                gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - whole
                gain[(n < LEAF) | (n[-1] - n < LEAF)] = 0
                k = int(gain[: len(edges[f])].argmax()) if len(edges[f]) else 0
                if len(edges[f]) and gain[k] > best[0]:
                    best = (gain[k], f, k)
        if best[1] < 0:
            total[rows] -= STEP * g[rows].sum() / (h[rows].sum() + 1)
            return
        _, f, k = best
        low = binned[rows, f] <= k
        bound = float(edges[f][k])
        split(rows[low], (*path, (names[f], False, bound)), depth + 1, g, h)
        split(rows[~low], (*path, (names[f], True, bound)), depth + 1, g, h)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        split(np.arange(len(y)), (), 0, p - y, p * (1 - p))
    return list(rules)


def lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 500) -> tuple[float, np.ndarray]:
    """Intercept and weights of a logistic model with an L1 penalty, by accelerated proximal steps."""
    spread = x.std(axis=0)
    spread[spread == 0] = 1
    z = (x - x.mean(axis=0)) / spread
    step = 4.0 / max(1e-9, np.linalg.norm(z, 2) ** 2 / len(y) + 1)
    w = look = np.zeros(x.shape[1])
    b = look_b = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    t = 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(z @ look + look_b))) - y
        new = look - step * (z.T @ error) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = look_b - step * error.mean()
        following = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, look_b = new + (t - 1) / following * (new - w), new_b + (t - 1) / following * (new_b - b)
        w, b, t = new, new_b, following
    weights = w / spread
    return float(b - (weights * x.mean(axis=0)).sum()), weights


def learn(values: np.ndarray, y: np.ndarray, names: tuple[str, ...] = STATISTICS) -> Model:
    """The model of labelled statistics (one row each); y is 0 or 1."""
    if len(y) == 0:
        return Model(0.0)
    if len(set(y.tolist())) < 2:
        return Model(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    edges = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(values.shape[1])]
    edges = [e[e < values[:, f].max()] for f, e in enumerate(edges)]
    binned = np.stack([np.searchsorted(edges[f], values[:, f], side="left") for f in range(values.shape[1])], axis=1)
    rules = grow(binned, edges, names, y)
    if not rules:
        return Model(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    x = np.stack([r.holds(values, names) for r in rules], axis=1).astype(np.float64)
    intercept, weights = lasso(x, y, PENALTY)
    return Model(intercept, tuple((float(w), r) for w, r in zip(weights, rules) if abs(w) > 1e-6))


# ---- jobs


def learned_from(labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """``doc_id, label, _order`` (staged): the labels that a model is fitted on, a few more than ``sample`` where there are
    more. Two labels at most for a doc_id."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).filter("label in (0, 1) and doc_id is not null")
    chosen = common.stage(chosen.distinct(), "labels")
    # chosen by a hash, so that the driver gets no more than it uses
    below = int((1 << 40) * min(1.0, 1.2 * sample / max(chosen.count(), 1)))
    return chosen.withColumn("_order", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))).filter(F.col("_order") < below)


def fit(statistics_rows: DataFrame, chosen: DataFrame, sample: int = SAMPLE) -> Model:
    """The model from statistics (with doc_id) and ``learned_from`` labels."""
    # one row of statistics for a doc_id, however often it is repeated
    own = statistics_rows.join(chosen.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*STATISTICS)).alias("s"))
    rows = own.join(chosen, "doc_id").select("s.*", "label", "_order").toPandas()
    rows = rows.sort_values(["_order", *STATISTICS, "label"], kind="stable").head(sample)
    return learn(rows[list(STATISTICS)].to_numpy(float).reshape(-1, len(STATISTICS)), rows["label"].to_numpy(float))


def training(labels: DataFrame) -> DataFrame:
    """The labels that may be learned from: those whose crc32(doc_id as text) mod 3 is not 1."""
    return labels.filter(common.fold(F.col("doc_id"), 3) != 1)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    rows = common.stage(measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "statistics")
    score = fit(rows, learned_from(training(labels))).score()
    return rows.select("doc_id", (common.fold(F.col("doc_id"), 3) == 1).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model predicts to be good.

    Only labelled rows are measured for the fit; then every row is scored in one pass over the texts.
    """
    chosen = learned_from(training(labels))
    # at most a few more than SAMPLE ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    model = fit(measured(texts), chosen)
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    found = measured(docs, tuple(docs.columns), prefix).filter(model.score(prefix) >= 0.5)
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
