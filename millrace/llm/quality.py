"""Quality classifier: a sparse rule ensemble compiled into column expressions.

Statistics of a text are built-in column functions. On a bounded sample of labelled rows the driver grows small
boosted trees in numpy, takes every path of a tree as a conjunctive rule, and fits lasso logistic weights to the rules.
Rules with a weight become one Spark expression, so scoring all documents is a map without Python and without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import table

#: At most so many labelled rows are taken to the driver for training: those of the smallest hash of the doc_id.
TRAIN_ROWS = 20_000
THRESHOLD = 0.3

STATISTICS = ("log_words", "word_chars", "distinct", "repeats", "pipes", "symbols", "shouts", "capitals", "digits", "stops", "commas", "line_words", "same_lines")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with a struct column _s of the STATISTICS of its whole texts, none of them null; null is an empty text."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")
    step = docs.withColumn("_t", t).withColumn("_w", words).withColumn("_l", F.split(t, "\n")).withColumn("_n", F.greatest(F.size("_w"), F.lit(1)).cast("double"))
    share = lambda c: (c / F.col("_n")).cast("double")
    chars = lambda c: F.length("_t") - F.length(F.replace("_t", F.lit(c)))
    count = lambda p: F.regexp_count("_t", F.lit(p))
    same = F.size(F.filter(F.zip_with("_w", F.slice("_w", 2, F.greatest(F.size("_w"), F.lit(1))), lambda a, b: a.eqNullSafe(b)), lambda x: x))
    values = {
        "log_words": F.log1p(F.size("_w").cast("double")),
        "word_chars": share(F.length("_t") - F.size("_w")),
        "distinct": share(F.size(F.array_distinct("_w"))),
        "repeats": share(same),
        "pipes": share(chars("|")),
        "symbols": share(count("[#$%&*@^~=_<>]{2,}")),
        "shouts": share(count("[!?]{2,}")),
        "capitals": count("\\p{Lu}") / (F.length("_t") + 1),
        "digits": count("[0-9]") / (F.length("_t") + 1),
        "stops": share(chars(".")),
        "commas": share(chars(",")),
        "line_words": F.col("_n") / F.size("_l"),
        "same_lines": 1 - F.size(F.array_distinct("_l")) / F.size("_l"),
    }
    return step.withColumn("_s", F.struct(*[values[k].cast("double").alias(k) for k in STATISTICS])).drop("_t", "_w", "_l", "_n")


@dataclass(frozen=True)
class Rule:
    """A conjunction: (statistic, above?, bound) each; above means greater, else at most."""

    tests: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[Rule, ...]

    def score(self) -> Column:
        """0 to 1 from the struct column _s."""
        total = F.lit(self.bias)
        for rule in self.rules:
            holds = None
            for name, above, bound in rule.tests:
                test = F.col(f"_s.{name}") > bound if above else F.col(f"_s.{name}") <= bound
                holds = test if holds is None else holds & test
            total = total + F.when(holds, F.lit(rule.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _grow(binned: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray, depth: int, least: int) -> list[tuple[tuple, np.ndarray, float]]:
    """The nodes of a regression tree: (tests, rows, value, leaf?) with tests as (feature, above, cut number)."""
    nodes, open_ = [], [((), np.arange(len(binned)))]
    while open_:
        tests, rows = open_.pop()
        g, h = gradient[rows], hessian[rows]
        best = (1e-6, None)
        if len(tests) < depth and len(rows) >= 2 * least:
            base = g.sum() ** 2 / (h.sum() + 1)
            for k, cut in enumerate(cuts):
                if not len(cut):
                    continue
                width = len(cut) + 1
                gs = np.cumsum(np.bincount(binned[rows, k], g, width))[:-1]
                hs = np.cumsum(np.bincount(binned[rows, k], h, width))[:-1]
                ns = np.cumsum(np.bincount(binned[rows, k], minlength=width))[:-1]
                gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - base
                gain[(ns < least) | (len(rows) - ns < least)] = -1
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (gain[at], (k, at))
        nodes.append((tests, rows, g.sum() / (h.sum() + 1), best[1] is None))
        if best[1] is not None:
            k, at = best[1]
            above = binned[rows, k] > at
            open_ += [((*tests, (k, False, at)), rows[~above]), ((*tests, (k, True, at)), rows[above])]
    return nodes


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic weights with an L1 penalty (the bias has none), by accelerated proximal gradient."""
    n = len(y)
    rate = 4 * n / (np.linalg.norm(x, 2) ** 2 + n)
    w, b = np.zeros(x.shape[1]), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    vw, vb, t = w, b, 1.0
    for _ in range(steps):
        error = _sigmoid(x @ vw + vb) - y
        nw = vw - rate * (x.T @ error) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - rate * penalty, 0)
        nb = vb - rate * error.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return float(b), w


def fit_rules(values: np.ndarray, quality: np.ndarray, *, trees: int = 24, depth: int = 3, bins: int = 32, rate: float = 0.3, penalty: float = 5e-4, seed: int = 5) -> RuleModel:
    """values: (rows, STATISTICS). With no rows the score is 0.5 throughout; with one class it is constant."""
    if not len(values):
        return RuleModel(0.0, ())
    y = quality.astype(np.float64)
    prior = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    if y.min() == y.max():
        return RuleModel(prior, ())
    cuts = []
    for k in range(values.shape[1]):
        edges = np.unique(np.quantile(values[:, k], np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
        cuts.append(edges[edges < values[:, k].max()])
    binned = np.stack([np.searchsorted(cut, values[:, k], side="left") for k, cut in enumerate(cuts)], axis=1)
    random, raw, found = np.random.default_rng(seed), np.full(len(y), prior), {}
    least = max(2, min(20, len(y) // 50))
    for _ in range(trees):
        some = np.sort(random.choice(len(y), max(2 * least, len(y) // 2), replace=False)) if len(y) >= 4 * least else np.arange(len(y))
        p = _sigmoid(raw[some])
        for tests, rows, value, leaf in _grow(binned[some], cuts, y[some] - p, p * (1 - p), depth, least):
            holds = np.ones(len(y), bool)
            for k, above, at in tests:
                holds &= (binned[:, k] > at) == above
            if leaf:
                raw[holds] += rate * value
            if tests and 0 < holds.sum() < len(y):
                found.setdefault(holds.tobytes(), (tests, holds))
    rules = sorted(found.values(), key=lambda r: (len(r[0]), r[0]))
    if not rules:
        return RuleModel(prior, ())
    x = np.stack([holds for _, holds in rules], axis=1).astype(np.float64)
    bias, weights = _lasso(x, y, penalty)
    return RuleModel(bias, tuple(Rule(tuple((STATISTICS[k], above, float(cuts[k][at])) for k, above, at in tests), float(w)) for (tests, _), w in zip(rules, weights) if w != 0))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS) -> RuleModel:
    """Fits on at most `rows` labelled documents that aren't held out.

    Labels whose doc_id or quality is null are left out; repeated labels of a document count by their mean.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    sample = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("_q")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    taken = with_statistics(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")).orderBy("doc_id").limit(rows).select("_q", "_s.*").toPandas()
    return fit_rules(taken[list(STATISTICS)].to_numpy(np.float64), taken["_q"].to_numpy())


def score(docs: DataFrame, model: RuleModel) -> DataFrame:
    """docs with the columns score and predicted; columns of these names are replaced, others pass through.

    Every row gets a score, with a null or empty text too. Repeated rows score alike; an empty table stays empty.
    """
    columns = [c for c in docs.columns if c not in ("score", "predicted")]
    rows = with_statistics(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row")), "_row.text")
    scored = rows.withColumn("_p", model.score())
    return scored.select("_row.*", F.col("_p").alias("score"), F.when(F.col("_p") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def op3_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
