"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is a hashed character n-gram of a lower-cased word (with its edges marked). Its value in a text is the log
ratio of its smoothed rates in toxic and in other training documents, times the logarithm of how often the text has it; a
logistic regression on these values gives the score. Counts for the ratios cover all training rows (of MAX_LABELS documents at most); only the
regression itself sees a smaller sample (MAX_FIT_ROWS per label), whose rows weigh so that each label counts as in
all training rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardlake.session import ship

from .common import at_most, slices, struct_of, text_column, written

ORDERS = (3, 4, 5, 6)
BINS = 1 << 20
#: Text bytes whose n-grams a worker holds at once; they take some 120 times as much.
FEATURE_BYTES = 1 << 18
#: What folds of the training rows choose from: the evidence (standard errors that a ratio is from none) from which a feature
#: counts, and the ridge. A feature must at least double or halve the odds (LEAST_RATIO): in large corpora whatever two labels differ in has
#: evidence, as documents repeat each other. Nothing fixes the number of features.
EVIDENCE, RIDGES = (3.0, 5.0), (1e-3, 3e-4)
LEAST_RATIO = float(np.log(2))
#: Rows of each label, lowest hash of the id first, that the regression is fitted on, and of these, those that are dealt into folds.
MAX_FIT_ROWS, FOLD_ROWS, FOLDS = 6000, 1000, 3
THRESHOLD = 0.7
SMOOTH = 0.5
#: The regression ends once no part of its gradient is larger, or after so many steps.
TOLERANCE, MAX_STEPS = 1e-5, 5000
SPLIT = re.compile(r"[\W_]+")


@dataclass(frozen=True)
class Model:
    """bins (sorted) and the weight of each, ratio included."""

    bins: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, owner: np.ndarray, bins: np.ndarray, times: np.ndarray, n: int) -> np.ndarray:
        """owner, bins: each pair once; times: how often."""
        z = np.full(n, self.bias)
        if len(self.bins) and len(bins):
            at = np.minimum(np.searchsorted(self.bins, bins), len(self.bins) - 1)
            hit = self.bins[at] == bins
            z += np.bincount(owner[hit], self.weights[at[hit]] * damped(times[hit]), n)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def damped(times: np.ndarray) -> np.ndarray:
    """1 for one occurrence, and one more each time that they double."""
    return np.log2(1.0 + times)


def features(texts: list[str | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text's number, bin, times), each pair once, sorted. wanted: a table over all bins; only the true ones are kept."""
    parts = [np.frombuffer(f" {' '.join(SPLIT.split(t.lower()))} ".encode("utf-32-le", "replace"), np.uint32) if t else np.zeros(0, np.uint32) for t in texts]
    owner = np.repeat(np.arange(len(parts), dtype=np.int64), [len(p) for p in parts])
    cp = np.concatenate([*parts, np.zeros(0, np.uint32)]).astype(np.uint64)
    space = np.cumsum(cp == 32)
    found = []
    with np.errstate(over="ignore"):
        for k in ORDERS:
            n = len(cp) - k + 1
            if n <= 0:
                continue
            h = np.full(n, k, np.uint64)
            for j in range(k):
                h = (h ^ cp[j : n + j]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            # within one text, and no space but at the edges: the n-gram is of one word
            inner = (space[k - 2 : n + k - 2] - space[:n] == 0) & (owner[:n] == owner[k - 1 :])
            bins = (h >> np.uint64(44)).astype(np.int64)
            if wanted is not None:
                inner &= wanted[bins]
            found.append(owner[:n][inner] * BINS + bins[inner])
    pairs, times = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]), return_counts=True)
    return pairs // BINS, pairs % BINS, times


def counts(train: DataFrame) -> DataFrame:
    """(label, bin, n): training documents of each label with the bin; bin -1 counts them all.

    Each task adds up before it sends anything: 2 x BINS rows at most, whatever its input.
    """

    def run(batches):
        total = np.zeros((2, BINS), np.int64)
        rows = np.zeros(2, np.int64)
        for batch in batches:
            labels = np.array(batch.column("label").to_pylist(), np.int64)
            at = 0
            for texts in slices(batch.column("text"), size=FEATURE_BYTES):
                owner, bins, _ = features(texts.to_pylist())
                part = labels[at : at + len(texts)]
                at += len(texts)
                rows += np.bincount(part, minlength=2)
                for label in (0, 1):
                    total[label] += np.bincount(bins[part[owner] == label], minlength=BINS)
        for label in (0, 1):
            at = np.flatnonzero(total[label])
            yield pa.RecordBatch.from_pydict({"label": np.full(len(at) + 1, label, np.int32), "bin": np.r_[at, -1].astype(np.int32), "n": np.r_[total[label][at], rows[label]]})

    ship(train.sparkSession)
    return train.select("label", "text").mapInArrow(run, "label int, bin int, n long").groupBy("label", "bin").agg(F.sum("n").alias("n"))


def ratios(train: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bins of the least evidence and ratio or more, sorted, their log-count ratios and evidence (a ratio over its standard error), and the
    rows of each label. BINS bounds what the driver gets."""
    of = lambda k: F.coalesce(F.sum(F.when(F.col("label") == k, F.col("n"))), F.lit(0))
    counted = written(counts(train).groupBy("bin").agg(of(0).alias("clean"), of(1).alias("toxic")), "toxicity-counts")
    total = counted.where("bin = -1").collect()
    if not total or not total[0].clean or not total[0].toxic:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros(2)
    rate = lambda c: F.log((F.col(c) + SMOOTH) / (total[0][c] + 2 * SMOOTH))
    ratio = rate("toxic") - rate("clean")
    evidence = F.abs(ratio) / F.sqrt(1 / (F.col("toxic") + SMOOTH) + 1 / (F.col("clean") + SMOOTH))
    found = counted.where(F.col("bin") >= 0).select("bin", ratio.alias("ratio"), evidence.alias("evidence")).where((F.col("evidence") >= min(EVIDENCE)) & (F.abs("ratio") >= LEAST_RATIO)).toPandas().sort_values("bin")
    return found["bin"].to_numpy(np.int64), found["ratio"].to_numpy(), found["evidence"].to_numpy(), np.array([total[0].clean, total[0].toxic], float)


def sample(train: DataFrame) -> DataFrame:
    """label, hash (of the id), text: of each label MAX_FIT_ROWS documents at most, lowest hash first, and one row of each, that of the least text hash."""
    ids = train.select("label", "doc_id").distinct()
    first = lambda k: ids.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_FIT_ROWS)
    chosen = train.join(F.broadcast(first(0).union(first(1))), ["label", "doc_id"], "left_semi")  # 2 * MAX_FIT_ROWS ids at most
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))
    return chosen.groupBy("label", "doc_id").agg(least.alias("least")).select("label", F.xxhash64("doc_id").alias("hash"), "least.text")


def fit(train: DataFrame) -> Model:
    """train: doc_id, text, label 0 or 1. Where one of the labels is missing every score is about 0."""
    bins, r, evidence, n_rows = ratios(train)
    if not len(bins):
        return Model(bins, r, -50.0)
    wanted = np.zeros(BINS, bool)
    wanted[bins] = True

    def run(batches):
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text"), size=FEATURE_BYTES):
                owner, found, times = features(texts.to_pylist(), wanted)
                cuts = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
                lists = {name: pa.ListArray.from_arrays(cuts, pa.array(v, pa.int32())) for name, v in (("bins", found), ("times", times))}
                yield pa.RecordBatch.from_pydict({**{c: batch.column(c).slice(at, len(texts)) for c in ("label", "hash")}, **lists})
                at += len(texts)

    rows = sample(train).mapInArrow(run, "label int, hash long, bins array<int>, times array<int>").toPandas().sort_values(["label", "hash"]).reset_index(drop=True)
    y, place = rows["label"].to_numpy(float), rows.groupby("label").cumcount().to_numpy()
    owner = np.repeat(np.arange(len(rows)), [len(x) for x in rows["bins"]])
    flat = lambda c: np.concatenate([*rows[c], np.zeros(0, np.int64)]).astype(np.int64)
    column, times = np.searchsorted(bins, flat("bins")), flat("times")
    found = np.bincount(rows["label"], minlength=2)
    weight = (n_rows / np.maximum(found, 1))[rows["label"]]
    value = r[column] * damped(times)
    least, ridge = chosen(owner, column, value, y, weight, evidence, place)
    w, bias = fitted(owner, column, value, y, weight, evidence >= least, ridge)
    return Model(bins[evidence >= least], (w * r)[evidence >= least], bias)


def fitted(owner: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, weight: np.ndarray, counts: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """regress() with the columns that count; the others get 0."""
    number, at = np.cumsum(counts) - 1, counts[column]
    w = np.zeros(len(counts))
    w[counts], bias = regress(owner[at], number[column[at]], value[at], y, weight, int(counts.sum()), ridge)
    return w, bias


def chosen(owner: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, weight: np.ndarray, evidence: np.ndarray, place: np.ndarray) -> tuple[float, float]:
    """The evidence and ridge of least loss on rows of other folds. place: of a row among those of its label; it tells its fold. With too few
    rows for folds, and of equal choices, the first."""
    choices = [(e, ridge) for e in EVIDENCE for ridge in RIDGES]
    dealt = np.where(place < FOLD_ROWS, place % FOLDS, -1)
    if min(np.bincount(y.astype(int), minlength=2)) < FOLDS:
        return choices[0]
    losses = []
    for least, ridge in choices:
        loss = 0.0
        for fold in range(FOLDS):
            taught, asked = (dealt >= 0) & (dealt != fold), dealt == fold
            number, at = np.cumsum(taught) - 1, taught[owner]
            w, bias = fitted(number[owner[at]], column[at], value[at], y[taught], weight[taught], evidence >= least, ridge)
            z = np.bincount(owner, value * w[column], len(y)) + bias
            loss += float(weight[asked] @ (np.logaddexp(0, z) - y * z)[asked])
        losses.append(loss)
    return choices[int(np.argmin(losses))]


def gradient(w: np.ndarray, bias: float, owner: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGES[0]) -> tuple[float, np.ndarray, float]:
    """The ridge logistic loss, its gradient by w and by the bias. weight sums to 1."""
    z = np.bincount(owner, value * w[column], len(y)) + bias
    miss = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
    return float(weight @ (np.logaddexp(0, z) - y * z) + ridge / 2 * (w @ w)), np.bincount(column, value * miss[owner], len(w)) + ridge * w, float(miss.sum())


def regress(owner: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, weight: np.ndarray, n_columns: int, ridge: float = RIDGES[0]) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by accelerated gradient steps. Steps are halved until they lessen the loss as a gradient
    step must, momentum starts anew where it points uphill, and it ends where the gradient is within TOLERANCE of 0.
    weight: the training rows that each row stands for."""
    weight = weight / weight.sum()
    at = lambda w, b: gradient(w, b, owner, column, value, y, weight, ridge)
    w, bias = np.zeros(n_columns), float(np.log((weight @ y + 1e-9) / (weight @ (1 - y) + 1e-9)))
    v, vb, curve, pace = w, bias, 1.0, 1.0
    for _ in range(MAX_STEPS):
        loss, g, gb = at(v, vb)
        if max(np.abs(g).max(initial=0.0), abs(gb)) < TOLERANCE:
            break
        while True:
            new, new_b = v - g / curve, vb - gb / curve
            if at(new, new_b)[0] <= loss - (g @ g + gb * gb) / (2 * curve) + 1e-12:
                break
            curve *= 2
        if g @ (new - w) + gb * (new_b - bias) > 0:
            pace = 1.0
        after = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        v, vb = new + (pace - 1) / after * (new - w), new_b + (pace - 1) / after * (new_b - bias)
        w, bias, pace, curve = new, new_b, after, curve * 0.95
    return v, vb


def score(df: DataFrame, model: Model, text: str = "text", into: str = "toxicity") -> DataFrame:
    """df with a struct column: score (0 to 1), predicted. A column of that name is replaced.

    Null and empty texts get the score of no feature. Equal texts get equal scores; long texts are read whole; an empty df gives no rows,
    and other columns keep their values."""
    wanted = np.zeros(BINS, bool)
    wanted[model.bins] = True

    def make():
        def work(texts: list) -> pa.Array:
            s = model.score(*features(texts, wanted), len(texts))
            return struct_of(score=s, predicted=(s >= THRESHOLD).astype(np.int32))

        return work

    return df.withColumn(into, text_column("score double, predicted int", make, size=FEATURE_BYTES)(F.col(text)))


#: Labelled documents that are learned from, at most (24 bytes each, broadcast); of more, those of the lowest hashes.
MAX_LABELS = 1_000_000


def training_rows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, label, written to the shared folder. A document with several label rows is toxic if any of them
    says so; null labels, ids and texts teach nothing. Of more than MAX_LABELS documents about so many are taken."""
    marks = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    marks = at_most(marks, MAX_LABELS)
    rows = documents.where("text is not null").select("doc_id", F.col("text").cast("string").alias("text")).join(marks, "doc_id")
    return written(rows, "toxicity-train")
