"""A sparse rule ensemble that scores texts for quality.

Shallow trees are grown on statistics of a bounded sample of labelled texts;
every path from a root is read as a rule, a conjunction of thresholds; a lasso
logistic regression gives weights to the rules and drops most; the rules that
stay are compiled into one Spark column over the statistics, so scoring is a
projection of the scan, without a shuffle and without Python.

Defined results: a null text counts as empty and is scored like any other; rows
without a label, or with another than 0 or 1, teach nothing; without both
labels in the sample every score is the share of label 1 (0.5 without any);
repeated rows are scored alike; extra columns are ignored or carried.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: Labelled rows that are learnt from at most, those of smallest hash: the bound on what the driver collects.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
#: Groups of signs that are counted, as share of the characters.
SIGNS = {
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": "0123456789",
    "space": " \t\r\x0b\x0c",
    "line": "\n",
    "stop": ".,;:",
    "shout": "!?",
    "mark": "#*$%&@^~",
    "bar": "|<>{}[]=_\\/+",
}


def statistics(text: str = "text") -> dict[str, Column]:
    """Name and column of each statistic of a text; every one is finite for any text."""
    body = text_or_empty(text)
    size = F.greatest(F.char_length(body), F.lit(1)).cast("double")
    words, lines = F.split(body, r"[ \t\r\x0B\f\n]+"), F.split(body, "\n")
    n_words = F.size(words).cast("double")
    out = {"log_chars": F.log1p(F.char_length(body).cast("double")), "word_chars": size / n_words}
    out |= {name: (F.char_length(body) - F.char_length(F.translate(body, signs, ""))) / size for name, signs in SIGNS.items()}
    out["distinct_words"] = F.size(F.array_distinct(words)) / n_words
    out["distinct_lines"] = F.size(F.array_distinct(lines)) / F.size(lines).cast("double")
    out["line_chars"] = F.log1p(size / F.size(lines))
    return out


@dataclass(frozen=True)
class Rule:
    """All of (statistic, above, bound) hold: value > bound if above, else value <= bound."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self, stats: dict[str, Column]) -> Column:
        return reduce(lambda a, b: a & b, [stats[n] > v if above else stats[n] <= v for n, above, v in self.terms])

    def holds(self, names: list[str], x: np.ndarray) -> np.ndarray:
        return np.all([(x[:, names.index(n)] > v) == above for n, above, v in self.terms], axis=0)


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, stats: dict[str, Column]) -> Column:
        """Probability of label 1."""
        total = reduce(lambda a, b: a + b, [F.when(r.column(stats), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.weights], F.lit(self.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def grow(x: np.ndarray, target: np.ndarray, names: list[str], bins: list[np.ndarray], depth: int, least: int) -> list[tuple]:
    """Nodes of a regression tree as (path, rows); splits lie on the given bounds."""
    out, open_nodes = [], [((), np.arange(len(x)))]
    while open_nodes:
        path, rows = open_nodes.pop()
        if path:
            out.append((path, rows))
        if len(path) >= depth or len(rows) < 2 * least:
            continue
        y, best = target[rows], None
        for j, bounds in enumerate(bins):
            cell = np.searchsorted(bounds, x[rows, j], side="left")  # cell k holds values <= bounds[k]
            n = np.cumsum(np.bincount(cell, minlength=len(bounds) + 1))[:-1]
            s = np.cumsum(np.bincount(cell, weights=y, minlength=len(bounds) + 1))[:-1]
            ok = (n >= least) & (len(rows) - n >= least)
            gain = np.where(ok, s**2 / np.maximum(n, 1) + (y.sum() - s) ** 2 / np.maximum(len(rows) - n, 1), -1.0)
            if len(gain) and gain.max() > (best[0] if best else y.sum() ** 2 / len(rows) + 1e-9):
                best = (gain.max(), j, float(bounds[gain.argmax()]))
        if best:
            _, j, bound = best
            above = x[rows, j] > bound
            open_nodes += [((*path, (names[j], side, bound)), rows[above == side]) for side in (False, True)]
    return out


def fit(x: np.ndarray, y: np.ndarray, names: list[str], *, trees: int = 60, depth: int = 3, least: int = 10, penalty: float = 0.002, seed: int = 7) -> RuleEnsemble:
    """Boosted shallow trees give the rules, each with a sample of rows; proximal gradient descent gives the weights."""
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or len(y) < 2 * least:
        share = min(max(share, 0.01), 0.99)
        return RuleEnsemble(float(np.log(share / (1 - share))), ())
    rng = np.random.default_rng(seed)
    bins = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 65)[1:-1], method="lower")) for j in range(x.shape[1])]
    raw, rules = np.full(len(y), np.log(share / (1 - share))), {}
    for _ in range(trees):
        own = np.sort(rng.choice(len(y), max(2 * least, int(0.7 * len(y))), replace=False))
        residual = y - 1 / (1 + np.exp(-raw))
        nodes = grow(x[own], residual[own], names, bins, depth, least)
        ends = {p for p, _ in nodes} - {p[:-1] for p, _ in nodes}
        for path, rows in nodes:
            rule = Rule(tuple(sorted(path)))
            rules.setdefault(rule.terms, rule)
            if path in ends:
                p = 1 / (1 + np.exp(-raw[own][rows]))
                step = residual[own][rows].sum() / ((p * (1 - p)).sum() + 1.0)
                raw = raw + 0.3 * float(np.clip(step, -4, 4)) * rule.holds(names, x)
    kept, columns = [], []
    for rule in rules.values():
        column = rule.holds(names, x).astype(float)
        if least <= column.sum() <= len(y) - least:
            kept.append(rule)
            columns.append(column)
    z = np.column_stack(columns) if columns else np.zeros((len(y), 0))
    spread = np.maximum(z.std(axis=0), 0.05)
    z = (z - z.mean(axis=0)) / spread
    weight, bias, ahead, t = np.zeros(z.shape[1]), np.log(share / (1 - share)), None, 1.0
    rate = 4.0 / (np.linalg.norm(z, 2) ** 2 / len(y) + 1)
    ahead, ahead_bias = weight.copy(), bias
    for _ in range(600):
        error = 1 / (1 + np.exp(-(z @ ahead + ahead_bias))) - y
        new = ahead - rate * (z.T @ error) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_bias = ahead_bias - rate * error.mean()
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, ahead_bias = new + (before - 1) / t * (new - weight), new_bias + (before - 1) / t * (new_bias - bias)
        weight, bias = new, new_bias
    used = np.flatnonzero(np.abs(weight) > 1e-6)
    means = np.array([c.mean() for c in columns]) if columns else np.zeros(0)
    scaled = weight / spread
    return RuleEnsemble(float(bias - (scaled * means)[used].sum()), tuple((kept[j], float(scaled[j])) for j in used))


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> RuleEnsemble:
    """Learns from the rows of docs that labels (doc_id, label) name; pass labels without those held out.

    The ids of the sample are chosen first, from the labels alone; they are at
    most sample_rows, so they are broadcast, and statistics are taken of their texts only.
    """
    own, mine = (f"{x}_{uuid.uuid4().hex}" for x in ("id", "label"))  # names that clash with no column of docs
    named = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias(own), F.col(label).cast("double").alias(mine))
    chosen = named.orderBy(F.xxhash64(own), own, mine).limit(sample_rows)
    stats = statistics(text)
    rows = docs.join(F.broadcast(chosen), F.col(doc_id) == F.col(own)).select(F.col(mine).alias("y"), F.col(own).alias("id"), *[c.alias(f"x_{n}") for n, c in stats.items()])
    names = list(stats)
    found = rows.orderBy(F.xxhash64("id"), "id", *[f"x_{n}" for n in names], "y").limit(sample_rows).toPandas()
    return fit(found[[f"x_{n}" for n in names]].to_numpy(float), found["y"].to_numpy(float), names)


def with_score(docs: DataFrame, model: RuleEnsemble, *, text: str = "text", to: str = "score") -> DataFrame:
    """docs with the score of each text; the statistics are worked out once a row."""
    stats = statistics(text)
    own = f"stats_{uuid.uuid4().hex}"
    held = docs.select("*", F.struct(*[c.cast("double").alias(n) for n, c in stats.items()]).alias(own))
    score = model.score({n: F.col(f"{own}.{n}") for n in stats})
    return held.select(*[F.col(f"`{c}`") for c in docs.columns if c != to], score.alias(to))


def keep_good(docs: DataFrame, model: RuleEnsemble, *, text: str = "text", least: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score least or more, with their columns.

    The planner would push the condition below the projection and so work out the
    statistics once more for each rule; it does not where the score could differ
    from one evaluation to the next, as it then has to assume.
    """
    score = f"score_{uuid.uuid4().hex}"
    scored = with_score(docs, model, text=text, to=score)
    once = scored.withColumn(score, F.when(F.monotonically_increasing_id() >= 0, F.col(score)))
    return once.where(F.col(score) >= least).select(*[F.col(f"`{c}`") for c in docs.columns])
