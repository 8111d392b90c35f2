"""Toxicity: cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import map_batches
from cellweave.session import cut, ship

#: Labelled documents that the model is fitted on, at most: those with the smallest hashes of their keys.
MAX_LABELLED = 20_000
#: Documents of the sample that a feature needs, and how much more frequent toxic ones must be among them.
LEAST_DOCS, LEAST_LIFT = 5, 2.0
#: Features that a model holds at most follow from the sample: each needs LEAST_DOCS of its documents.
GRADES = 3
_words = re.compile(r"\w+").findall
#: Beginnings of words that are features, and the numbers of such words (or more) that are told apart.
PREFIXES, TIMES = (4, 6), 3
#: Standard deviations by which a feature must be more frequent in toxic documents than by chance.
LEAST_Z = 6.0


def features(text: str | None) -> set[str]:
    """Lower-case words, and beginnings of longer ones with how often they occur: once, twice, more."""
    if not text:
        return set()
    words = _words(text.lower())
    out = set(words)
    for n in PREFIXES:
        for start, times in Counter(w[:n] for w in words if len(w) > n).items():
            out.update(f"{start}*{i}" for i in range(1, min(times, TIMES) + 1))
    return out


@dataclass
class OrdinalModel:
    """P(grade > k) = sigmoid(weights . x - cuts[k]); one weight vector for all thresholds."""

    weights: dict[str, float]
    cuts: tuple[float, ...]

    def __post_init__(self) -> None:
        starts = {f.rpartition("*")[0] for f in self.weights if "*" in f}
        self.starts = {n: {s for s in starts if len(s) == n} for n in PREFIXES}

    def score(self, text: str | None) -> float:
        """The weights of ``features(text)``, made for the starts that have weights only."""
        if not text or not self.weights:
            return 0.0
        words = _words(text.lower())
        get = self.weights.get
        out = math.fsum(get(w, 0.0) for w in self.weights.keys() & set(words))
        for n, starts in self.starts.items():
            if starts:
                for start, times in Counter([w[:n] for w in words if w[:n] in starts and len(w) > n]).items():
                    out += sum(get(f"{start}*{i}", 0.0) for i in range(1, min(times, TIMES) + 1))
        return out

    def chances(self, text: str | None) -> tuple[float, ...]:
        score = self.score(text)
        return tuple(1 / (1 + math.exp(max(-50.0, min(50.0, c - score)))) for c in self.cuts)


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, n_cols: int, grade: np.ndarray, l1_docs: float = 0.3, steps: int = 600) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered cuts that maximise the likelihood of the grades, less a penalty on the weights.

    The penalty is the sum of their sizes, worth ``l1_docs`` documents. Accelerated proximal
    gradient steps, for each weight as long as the documents that have its feature allow. Cuts are the first one and positive distances, so they stay in order.
    """
    n, k = len(grade), GRADES - 1
    share = [(grade > j).mean() for j in range(k)]
    logit = [-np.log(np.clip(s, 1e-4, 1 - 1e-4) / (1 - np.clip(s, 1e-4, 1 - 1e-4))) for s in share]
    free = np.array([logit[0], *[np.log(max(1e-2, logit[j] - logit[j - 1])) for j in range(1, k)]])
    w = np.zeros(n_cols)
    v, u, t = w.copy(), free.copy(), 1.0
    per = np.bincount(rows, minlength=n).astype(float)
    step = 1.0 / np.maximum(0.5 * np.bincount(cols, weights=per[rows], minlength=n_cols) / n, 1e-9)
    l1 = l1_docs / n
    for _ in range(steps):
        cuts = np.cumsum(np.array([u[0], *np.exp(u[1:])]))
        score = np.bincount(rows, weights=v[cols], minlength=n)
        p = 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -50, 50)))  # P(grade > j)
        upper = np.hstack([np.ones((n, 1)), p])
        lower = np.hstack([p, np.zeros((n, 1))])
        at = np.arange(n)
        chance = np.maximum(upper[at, grade] - lower[at, grade], 1e-12)
        slope = p * (1 - p)
        up = np.hstack([np.zeros((n, 1)), slope])[at, grade]
        low = np.hstack([slope, np.zeros((n, 1))])[at, grade]
        g_score = -(up - low) / chance / n
        g_cuts = np.zeros(k)
        for j in range(k):
            g_cuts[j] = ((np.where(grade == j + 1, slope[:, j], 0) - np.where(grade == j, slope[:, j], 0)) / chance).sum() / n
        g_w = np.bincount(cols, weights=g_score[rows], minlength=n_cols)
        tail = np.cumsum(g_cuts[::-1])[::-1]
        g_u = np.array([tail[0], *(tail[1:] * np.exp(u[1:]))])
        new_w = v - step * g_w
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * l1, 0)
        new_u = u - 0.5 * g_u
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, u = new_w + (t - 1) / t_new * (new_w - w), new_u + (t - 1) / t_new * (new_u - free)
        w, free, t = new_w, new_u, t_new
    return w, np.cumsum(np.array([free[0], *np.exp(free[1:])]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_labelled: int = MAX_LABELLED) -> OrdinalModel:
    """A model of severity from labels: 0 clean, 1 toxic, 2 severe.

    Labels with grades above 1 are taken as they are. Labels of 0 and 1 say nothing of severity,
    so the amount of evidence stands for it: a toxic document has grade 2 if it has at least the
    median number (over toxic documents of the sample) of features that mark toxicity. These
    are features of the model too, so the second threshold then grades the amount of toxic
    wording, not a judgement of its own; ``toxic`` depends on the first threshold only.

    Only documents with a key and a label count; if labels of a key differ, the highest holds.
    The sample has at most ``max_labelled`` keys and one text for each (of several texts of a
    key that with the smallest hash), so it is bounded whatever the tables hold; it is stored
    once, and its counts of marked features come to the driver. No labels, or none of either
    class, give a model that finds nothing toxic.
    """
    spark = docs.sparkSession
    ship(spark)
    chosen = (
        labels.select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").cast("int").alias("y"))
        .where(F.col("k").isNotNull() & F.col("y").isNotNull())
        .groupBy("k").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("k"), "k").limit(max_labelled)
    )
    found = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).join(F.broadcast(chosen), "k").where(F.col("t").isNotNull())
    one = F.min_by("t", F.struct(F.xxhash64("t"), F.col("t"))).alias("t")
    tasks = max(32, 4 * spark.sparkContext.defaultParallelism)  # else the small sample is put together into one task
    sample = cut(found.groupBy("k").agg(F.max("y").alias("y"), one).repartition(tasks, "k"))

    def marks(batch):
        counts: dict[str, list[int]] = {}
        ys = batch.column("y").to_pylist()
        for t, y in zip(batch.column("t").to_pylist(), ys, strict=True):
            for f in features(t):
                c = counts.setdefault(f, [0, 0])
                c[0] += 1
                c[1] += y > 0
        counts[""] = [len(ys), sum(y > 0 for y in ys)]
        return {"f": list(counts), "n": [c[0] for c in counts.values()], "m": [c[1] for c in counts.values()]}

    totals = map_batches(sample, marks, "f string, n long, m long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    found = totals.where((F.col("f") == "") | (F.col("n") >= LEAST_DOCS) & (F.col("m") >= 2)).toPandas()
    every = found[found.f == ""]
    n, m = (int(every.n.iloc[0]), int(every.m.iloc[0])) if len(every) else (0, 0)
    if not 0 < m < n:
        return OrdinalModel({}, (50.0,) * (GRADES - 1))
    base = m / n
    z = (found.m - found.n * base) / np.sqrt(found.n * base * (1 - base))
    found = found[(found.f != "") & (z >= LEAST_Z) & (found.m / found.n >= min(LEAST_LIFT * base, 0.5 + base / 2))].sort_values("f")
    place = {f: i for i, f in enumerate(found.f)}
    held = spark.sparkContext.broadcast(place)

    def rows(batch):
        place = held.value
        return {"y": batch.column("y"), "x": [sorted(place[f] for f in features(t) if f in place) for t in batch.column("t").to_pylist()]}

    data = map_batches(sample, rows, "y int, x array<int>").toPandas()
    order = sorted(range(len(data)), key=lambda i: (data.y[i], list(data.x[i])))  # the fit doesn't depend on the order of rows
    ys, xs = np.array([int(data.y[i] > 0) for i in order]), [np.asarray(data.x[i], dtype=np.int64) for i in order]
    sizes = np.array([len(x) for x in xs])
    typical = max(1.0, float(np.median(sizes[ys > 0])))
    given = np.array([data.y[i] for i in order])
    grade = np.minimum(np.maximum(given, 0), GRADES - 1) if given.max() > 1 else np.where(ys > 0, 1 + (sizes >= typical), 0)
    flat = np.concatenate(xs) if sizes.sum() else np.zeros(0, dtype=np.int64)
    w, cuts = fit_ordinal(np.repeat(np.arange(len(xs)), sizes), flat, max(1, len(place)), grade)
    names = list(place)
    return OrdinalModel({names[i]: float(w[i]) for i in np.flatnonzero(w[: len(names)])}, tuple(map(float, cuts)))


def score_toxicity(docs: DataFrame, model: OrdinalModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: the key, ``severity`` (expected grade), ``grade`` (the likeliest) and ``toxic``.

    ``toxic`` is true where a grade above 0 is likelier than not. A null or an empty text
    has no features and so the lowest severity. Whole texts are read, without a shuffle.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    kind = dict(narrow.dtypes)["k"]

    def run(batch):
        model = held.value
        chances = [model.chances(t) for t in batch.column("t").to_pylist()]
        grades = []
        for c in chances:
            each = [a - b for a, b in zip((1.0, *c), (*c, 0.0), strict=True)]
            grades.append(each.index(max(each)))
        return {"k": batch.column("k"), "severity": [round(sum(c), 6) for c in chances], "grade": grades, "toxic": [c[0] >= 0.5 for c in chances]}

    return map_batches(narrow, run, f"k {kind}, severity double, grade int, toxic boolean").withColumnRenamed("k", key)


def drop_toxic(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """The documents that are not toxic, with all their columns; each row is judged by its text alone."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([held.value.chances(t if isinstance(t, str) else None)[0] < 0.5 for t in texts], dtype=bool)

    return docs.where(clean(F.col(f"`{text}`")))
