"""Bradley-Terry quality classifier: document scores learned from preference pairs, cut at a score quantile.

Good and bad labelled documents form preference pairs; the probability that the good one is preferred is the logistic
function of the difference of two scores, and a score is linear in features of the text. The weights minimise the
logistic loss on the feature differences. The cut lies at the quantile of the training scores below which as large a
share lies as bad documents have among the labels, and `score` is 0.5 there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areastats.llm.common import CUT, label_hash, materialise
from areastats.operators.ranking import with_rank

SPACE = " \t\n\x0b\f\r"


def feature_columns(text: Column) -> dict[str, Column]:
    """Features of a whole text by built-in functions, all finite, all 0 for null and empty texts but `empty`.

    Shares and logarithms, so that length alone does not decide. No feature sees labels, language, source or id.
    """
    text = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, CUT))
    return {"text": text, "words": words}


#: Each over `text` and `words`; `n` the number of words, at least 1, `c` of code points, at least 1.
FEATURES = {
    "empty": "if(size(words) = 0, 1D, 0D)",
    "log_words": "log1p(size(words)) / 10",
    "few_words": "if(size(words) < 10, 1D, 0D)",
    "symbols": "least(1D, 4D * regexp_count(text, '[#*$%&<>{}~^]') / c)",
    "bars": "least(1D, regexp_count(text, '[|]') / n)",
    "digits": "regexp_count(text, '[0-9]') / c",
    "upper": "regexp_count(text, '[A-Z]') / c",
    "stops": "least(1D, 4D * regexp_count(text, '[.!?]') / n)",
    "commas": "least(1D, 4D * regexp_count(text, ',') / n)",
    "lines": "least(1D, 4D * regexp_count(text, '\\n') / n)",
    "word_length": "least(1D, (c - n + 1) / n / 20)",
    "distinct_words": "size(array_distinct(transform(words, w -> xxhash64(w)))) / n",
    "log_distinct": "log1p(size(array_distinct(transform(words, w -> xxhash64(w))))) / 10",
    "repeats": "least(1D, greatest(0D, 1D - size(array_distinct(transform(words, w -> xxhash64(w)))) / pow(n, 0.85D)))",
    "short_words": "regexp_count(text, '(?<![^ \\t\\n\\x0B\\f\\r])[^ \\t\\n\\x0B\\f\\r]{1,3}(?![^ \\t\\n\\x0B\\f\\r])') / n",
}


def featured(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the array of features and the columns to keep of every row."""
    parts = feature_columns(docs["text"])
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), *keep, *[v.alias(k) for k, v in parts.items()])
    base = base.withColumns({"n": F.greatest(F.size("words"), F.lit(1)), "c": F.greatest(F.length("text"), F.lit(1))})
    cells = [f"cast({e.replace(chr(92), chr(92) * 2)} as double)" for e in FEATURES.values()]
    return base.select("doc_id", *keep, F.expr(f"array({', '.join(cells)})").alias("x"))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float


def newton(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], width: int, n: int, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights that minimise the mean logistic loss of `n` pairs, by Newton steps; `sums` is `pair_sums` over all of them."""
    w = np.zeros(width)
    for _ in range(steps):
        slope, curve = sums(w)
        step = np.linalg.solve(curve / n + ridge * np.eye(width), ridge * w - slope / n)
        w = w - step * min(1.0, 4.0 / max(1e-12, np.linalg.norm(step)))
        if np.linalg.norm(step) < 1e-8:
            break
    return w


def pair_sums(diff: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of slope and curvature over feature differences (good minus bad)."""
    p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))  # probability of the wrong order
    return (diff * p[:, None]).sum(axis=0), (diff * (p * (1 - p))[:, None]).T @ diff


def neutral() -> Model:
    """All scores 0.5: no rows, or one class only."""
    width = len(FEATURES)
    return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, seed: int = 11) -> Model:
    """The model of a few rows in memory, from as many pairs as there are of good and bad; tables go through `train`."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return neutral()
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = (x - mean) / scale
    n = len(good) * len(bad)
    diff = z[good[np.random.default_rng(seed).permutation(n) % len(good)]] - z[bad[np.arange(n) % len(bad)]]
    w = newton(lambda w: pair_sums(diff, w), len(FEATURES), n, ridge)
    order = np.sort(z @ w)
    k, near = _near(len(bad) / len(y), len(order))
    best = max(near, key=lambda i: order[i] - order[i - 1], default=None)
    return Model(mean, scale, w, float(order[k] if best is None else (order[best] + order[best - 1]) / 2), 1.0)


def _near(share: float, n: int) -> tuple[int, range]:
    """The rank of the share, and the ranks close to it before which the cut may lie."""
    k = int(round(share * n))
    return min(k, n - 1), range(max(1, int(k * 0.95)), min(n - 1, int(k * 1.05) + 1) + 1)


def _cut(scores: DataFrame, share: float, n: int) -> float:
    """The score quantile of the share; where a wider gap lies close to it, the middle of that gap, so ties stay together."""
    k, near = _near(share, n)
    ranked = with_rank(scores, [], ["s", "doc_id"])
    if not len(near):
        return float(ranked.where(F.col("rank") == k).first()["s"])
    own = ranked.where(F.col("rank").between(near[0], near[-1])).select("rank", "s")
    before = ranked.where(F.col("rank").between(near[0] - 1, near[-1] - 1)).select((F.col("rank") + 1).alias("rank"), F.col("s").alias("low"))
    gaps = own.join(before.hint("merge"), "rank")
    widest = gaps.agg(F.max(F.struct((F.col("s") - F.col("low")).alias("gap"), (-F.col("rank")).alias("back"), "s", "low")).alias("w")).first()["w"]
    return (widest["s"] + widest["low"]) / 2


def known_labels(labels: DataFrame) -> DataFrame:
    """l_id and quality of the labels outside the held-out fold (crc32 of the id modulo 3 is 1); null ids and labels go."""
    known = labels.where("quality in (0, 1) and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("l_id"), F.col("quality").cast("int").alias("quality")
    )
    return known.where(label_hash(F.col("l_id"), 3) != 1)


def preference_pairs(rows: DataFrame, good: int, bad: int, z: Column, least: int = 200_000, turns: int = 4) -> DataFrame:
    """Feature differences `d` (good minus bad): each row of the larger class meets rows of the other in turn.

    All pairs while they are at most `least`, else at least so many and no fewer than `turns` for each row; their number
    grows with the labels, and every labelled row stands in pairs, those of one class equally often but for one turn.
    """
    more, fewer = (1, 0) if good >= bad else (0, 1)
    many, few = max(good, bad), min(good, bad)
    rounds = min(few, max(turns, -(-least // many)))
    ranked = with_rank(rows.withColumn("_h", F.xxhash64("quality", "doc_id")), ["quality"], ["_h", "doc_id", "x"])
    left = ranked.where(F.col("quality") == more).select("rank", z.alias("l"), F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("turn"))
    left = left.withColumn("other", F.pmod(F.col("rank") + F.col("turn"), F.lit(few)))
    right = ranked.where(F.col("quality") == fewer).select(F.col("rank").alias("other"), z.alias("r"))
    sign = 1 if more == 1 else -1
    met = left.join(right.hint("merge"), "other").select("rank", "turn", F.expr(f"zip_with(l, r, (a, b) -> (a - b) * {sign}D)").alias("d"))
    return materialise(met.sortWithinPartitions("rank", "turn").select("d"))


def train_rows(rows: DataFrame) -> Model:
    """The model of all labelled rows (doc_id, quality, x). To the driver come counts, moments and sums over pairs only.

    An id with several labels or texts counts once for each. Moments and weights are rounded to nine digits, below
    which sums depend on the order of the tasks.
    """
    rows, width = materialise(rows), len(FEATURES)
    moments = [f(F.col("x")[i]).alias(f"{k}{i}") for k, f in (("m", F.avg), ("s", F.stddev_pop)) for i in range(width)]
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"), *moments).first()
    n, good = total["n"], total["good"]
    if not good or good == n:
        return neutral()
    mean = np.round([total[f"m{i}"] for i in range(width)], 9)
    scale = np.round(np.maximum([total[f"s{i}"] for i in range(width)], 1e-6), 9)
    z = F.array(*[(F.col("x")[i] - float(mean[i])) / float(scale[i]) for i in range(width)])
    pairs = preference_pairs(rows, good, n - good, z)

    def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            slope, curve, count = np.zeros(width), np.zeros((width, width)), 0
            for batch in batches:
                diff = batch.column(0).flatten().to_numpy().reshape(-1, width)
                one, two = pair_sums(diff, w)
                slope, curve, count = slope + one, curve + two, count + len(diff)
            yield pa.RecordBatch.from_pydict({"n": [count], "s": [[*slope, *curve.ravel()]]})

        parts = pairs.mapInArrow(run, "n long, s array<double>").collect()
        parts = np.sum(sorted(r["s"] for r in parts), axis=0)
        return parts[:width], parts[width:].reshape(width, width)

    w = np.round(newton(sums, width, pairs.count()), 9)
    model = Model(mean, scale, w, 0.0, 1.0)
    model.cut = _cut(rows.select("doc_id", F.expr(_raw(model)).alias("s")), (n - good) / n, n)
    return model


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of all labelled documents outside the held-out fold."""
    text = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    met = text.join(known_labels(labels), F.col("doc_id") == F.col("l_id"))
    return train_rows(featured(met.select("doc_id", "text", "quality"), "quality"))


def _raw(model: Model, cells: list[str] | None = None) -> str:
    """Score before the logistic function, from `x` or from SQL for each feature."""
    weight = model.weights / model.scale
    shift = -float(model.mean @ weight) - model.cut
    terms = " + ".join(f"{cells[i] if cells else f'x[{i}]'} * {float(w)!r}D" for i, w in enumerate(weight))
    return f"({terms} + {shift!r}D) * {model.slope!r}D"


def scored(features: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score in 0 to 1 and predicted for every row of `featured`, whatever its text."""
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.greatest(F.expr(_raw(model)), F.lit(-30.0)), F.lit(30.0))))
    return features.select(
        "doc_id", (label_hash(F.col("doc_id"), 3) == 1).alias("held_out"), score.alias("score")
    ).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all `docs` from a model trained on all their labelled rows outside the held-out fold.

    Null and empty texts are scored like any other from their features; repeated rows are scored each; empty documents
    give no rows; without labels of both classes every score is 0.5. Other columns are not looked at. The features are
    computed once and written, fifteen numbers a row.
    """
    features = materialise(featured(docs))
    met = features.join(known_labels(labels), F.col("doc_id") == F.col("l_id"))
    return scored(features, train_rows(met.select("doc_id", "quality", "x")))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that the classifier predicts as good, with their columns; one pass after the training."""
    model = train(docs, labels)
    row = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    parts = feature_columns(row["text"])
    return _keep(row, parts, model).select("row.*")


def _keep(row: DataFrame, parts: dict[str, Column], model: Model) -> DataFrame:
    base = row.select("row", *[v.alias(k) for k, v in parts.items()])
    base = base.withColumns({"n": F.greatest(F.size("words"), F.lit(1)), "c": F.greatest(F.length("text"), F.lit(1))})
    cells = [f"cast({e.replace(chr(92), chr(92) * 2)} as double)" for e in FEATURES.values()]
    return base.where(F.expr(f"1D / (1D + exp(-least(greatest({_raw(model, cells)}, -30D), 30D))) >= 0.5D"))
