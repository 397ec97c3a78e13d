"""Text quality by a sparse rule ensemble.

Shallow boosted trees are grown on statistics of labelled texts; every path from a root to an inner node or leaf becomes a
conjunctive rule; a logistic model with a lasso penalty weighs the rules, most of which get no weight; the rest are
compiled into one Spark column expression, so that scoring is a map over the texts without any Python.

The fit takes at most `sample` labelled documents, those with the least hash of their id; scoring covers every text whole.

Defined results: a null text is an empty text and gets a score like any other; labels that are null or whose document is
missing are left out; of several labels of one document the largest counts, of several rows of a document each; without
both classes among the labels every text gets the share of label 1 (0.5 if there are no labels); other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 12_000
BINS, DEPTH, TREES = 32, 3, 40


def statistics(text: Column) -> dict[str, Column]:
    """The statistics that rules speak of, JVM-side; each is a double."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t).cast("double")
    some = F.greatest(n, F.lit(1.0))
    words = F.split(t, "[ \n]")
    lines = F.split(t, "\n")
    n_words = F.size(words).cast("double")
    share = lambda chars: (n - F.length(F.translate(t, chars, ""))) / some
    kept = lambda pattern: F.length(F.regexp_replace(t, pattern, "")) / some
    return {
        "n_chars": n,
        "n_words": n_words,
        "word_length": n / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "line_length": n / F.size(lines),
        "upper": kept(r"[^\p{Lu}]+"),
        "digits": kept("[^0-9]+"),
        "symbols": share("#$%&*@^~"),
        "bars": share("|"),
        "brackets": share("<>{}[]()=/\\_"),
        "exclaimed": share("!?"),
        "stops": share("."),
        "commas": share(","),
        "blanks": share(" \n"),
    }


@dataclass
class Ensemble:
    """Rules (each a list of (statistic, is_over, cut)), their weights, and the bias."""

    bias: float
    rules: list[list[tuple[str, bool, float]]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)


def _tree(binned: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int = DEPTH):
    """One boosted tree on binned statistics: its paths and the value of each row."""
    value, paths = np.zeros(len(grad)), []

    def grow(rows: np.ndarray, path: list) -> None:
        g, h = grad[rows], hess[rows]
        best, at = 1e-6, None
        if len(path) < depth and len(rows) >= 40:
            for f in range(binned.shape[1]):
                b = binned[rows, f]
                gl, hl, nl = (np.cumsum(np.bincount(b, w, BINS))[:-1] for w in (g, h, None))
                gr, hr = g.sum() - gl, h.sum() - hl
                gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
                gain[(nl < 15) | (nl > len(rows) - 15)] = 0
                if gain.max() > best:
                    best, at = gain.max(), (f, int(gain.argmax()))
        if path:
            paths.append(list(path))
        if at is None:
            value[rows] = -g.sum() / (h.sum() + 1)
            return
        over = binned[rows, at[0]] > at[1]
        grow(rows[~over], [*path, (at[0], False, at[1])])
        grow(rows[over], [*path, (at[0], True, at[1])])

    grow(np.arange(len(grad)), [])
    return paths, value


def _holds(binned: np.ndarray, rule: list) -> np.ndarray:
    out = np.ones(len(binned), bool)
    for f, over, cut in rule:
        out &= (binned[:, f] > cut) == over
    return out


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with an l1 penalty, by accelerated proximal gradient; the bias has no penalty."""
    n, k = x.shape
    lip = 0.25 * (np.linalg.norm(x, 2) ** 2 / n + 1)
    w, b = np.zeros(k), np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))
    vw, vb, t = w, b, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ vw + vb, -30, 30)))
        nw = vw - x.T @ (p - y) / n / lip
        nw = np.sign(nw) * np.maximum(np.abs(nw) - penalty / lip, 0)
        nb = vb - (p - y).mean() / lip
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, float(b)


def fit_arrays(x: np.ndarray, y: np.ndarray, names: list[str], penalty: float = 0.0005) -> Ensemble:
    """The ensemble from a matrix of statistics and 0/1 labels."""
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        return Ensemble(float(np.log((share or 1e-6) / (1 - share or 1e-6))))
    cuts = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], 1)
    margin, rules = np.full(len(y), np.log(share / (1 - share))), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        paths, value = _tree(binned, p - y, p * (1 - p))
        margin = margin + 0.3 * value
        for path in paths:
            rules.setdefault(tuple(sorted(path)), None)
    rules = list(rules)
    held = np.stack([_holds(binned, r) for r in rules], 1).astype(np.float32)
    weights, bias = _lasso(held, y.astype(np.float32), penalty)
    kept = [k for k in range(len(rules)) if abs(weights[k]) > 1e-6]
    return Ensemble(bias, [[(names[f], over, float(cuts[f][min(cut, len(cuts[f]) - 1)])) for f, over, cut in rules[k]] for k in kept], [float(weights[k]) for k in kept])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Ensemble:
    """Learns from the labelled rows of `docs`. Both steps that choose rows see ids alone; `sample` bounds what is broadcast."""
    y = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
    ids = docs.select(F.col(id_col).alias("_id")).where(F.col("_id").isNotNull())
    chosen = ids.join(y, "_id").dropDuplicates(["_id"]).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    stats = statistics(F.col("_text"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    found = rows.select("_y", *(c.alias(n) for n, c in stats.items())).limit(2 * sample).toPandas()
    return fit_arrays(found[list(stats)].to_numpy(float), found["_y"].to_numpy(float), list(stats))


def score(model: Ensemble, text: Column) -> Column:
    """The compiled ensemble: the probability of label 1."""
    stats = statistics(text)
    used = sorted({f for r in model.rules for f, _, _ in r})
    held = F.struct(F.lit(0).alias("none"), *(stats[f].alias(f) for f in used))

    def total(s: Column) -> Column:
        out = F.lit(model.bias)
        for rule, w in zip(model.rules, model.weights, strict=True):
            holds = F.lit(True)
            for f, over, cut in rule:
                holds = holds & (s[f] > cut if over else s[f] <= cut)
            out = out + F.when(holds, F.lit(w)).otherwise(0.0)
        return 1 / (1 + F.exp(-out))

    return F.get(F.transform(F.array(held), total), F.lit(0))
