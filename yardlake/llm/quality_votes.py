"""Quality: the labels of a document's nearest labelled neighbours, weighed by similarity.

A text is counted in TERMS hashed terms: its words, n-grams of character classes (which see case, digits, marks and layout), and
words that repeat the word before them. Counts are damped, weighed by how few documents of the whole corpus have the term,
and projected to RANK latent-semantic dimensions, the leading singular vectors of labelled documents. The labelled vectors
are bounded in number (MAX_ROWS a label) and sent to every task, which multiplies them with blocks of documents: exact cosines
with all of them, of which the NEIGHBOURS highest vote.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardlake.session import ship

from .common import at_most, slices, struct_of, text_column, written

#: Hashed words, and hashed n-grams of classes, of these lengths; two more terms are repetitions.
WORDS, GRAMS, ORDERS = 1 << 12, 1 << 12, (2, 3, 4)
TERMS = WORDS + GRAMS + 2
#: Latent dimensions; labelled documents of each label that are neighbours (2 MB of vectors in all) and of these, those that the
#: dimensions are fitted on: lowest hash of the id first.
RANK, MAX_ROWS, BASIS_ROWS = 48, 4096, 2048
NEIGHBOURS = 25
#: A vote counts as its similarity to this power; all votes together are joined by one of this weight for the rate of all labels.
POWER, PRIOR = 8, 0.05
THRESHOLD = 0.3
#: Texts in a block of products, and steps of the subspace iteration.
BLOCK, STEPS = 256, 4


def classes() -> np.ndarray:
    """The class of each code point below 0x250; ASCII marks are classes of their own, code points beyond are one."""
    out = np.zeros(0x251, np.uint64)
    for c in range(0x250):
        x = chr(c)
        out[c] = 1 if x.islower() else 2 if x.isupper() else 3 if x.isdigit() else c if c < 127 else 4
    out[0x250] = 1
    return out


CLASSES = classes()
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * M1
    return h ^ (h >> np.uint64(29))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(f" {t} ".encode("utf-32-le", "replace") if t else b"", np.uint32) for t in texts]
    owner = np.repeat(np.arange(len(parts), dtype=np.int64), [len(p) for p in parts])
    return np.concatenate([*parts, np.zeros(0, np.uint32)]), owner


def terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text's number, term, times), each pair once, sorted."""
    texts = [t or "" for t in texts]
    found = []
    with np.errstate(over="ignore"):
        cp, owner = code_points([t.lower() for t in texts])
        inside = cp > 32
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        if len(starts):
            place = np.arange(len(cp)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(cp)]))
            letters = np.where(inside, mixed(cp.astype(np.uint64) * M2 + place.astype(np.uint64) * M1), np.uint64(0))
            word = mixed(np.add.reduceat(letters, starts) + (ends - starts).astype(np.uint64))
            of = owner[starts]
            found.append(of * TERMS + (word % np.uint64(WORDS)).astype(np.int64))
            again = (word[1:] == word[:-1]) & (of[1:] == of[:-1])
            found.append(of[1:][again] * TERMS + WORDS + GRAMS)
            thrice = again[1:] & again[:-1]
            found.append(of[2:][thrice] * TERMS + WORDS + GRAMS + 1)
        cp, owner = code_points(texts)
        kind = CLASSES[np.minimum(cp, 0x250)]
        # a run of one class counts as two of it
        keep = np.ones(len(kind), bool)
        keep[2:] = (kind[2:] != kind[1:-1]) | (kind[2:] != kind[:-2]) | (owner[2:] != owner[:-2])
        kind, owner = kind[keep], owner[keep]
        for k in ORDERS:
            n = len(kind) - k + 1
            if n > 0:
                h = np.full(n, k, np.uint64)
                for j in range(k):
                    h = (h ^ kind[j : n + j]) * M2
                    h ^= h >> np.uint64(29)
                same = owner[:n] == owner[k - 1 :]
                found.append((owner[:n] * TERMS + WORDS + (mixed(h) % np.uint64(GRAMS)).astype(np.int64))[same])
    pairs, times = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]), return_counts=True)
    return pairs // TERMS, pairs % TERMS, times


def document_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents of the whole corpus that have each term, and documents in all; a task adds up before it sends TERMS rows at most."""

    def run(batches):
        total, rows = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for texts in slices(batch.column("text")):
                total += np.bincount(terms(texts.to_pylist())[1], minlength=TERMS)
                rows += len(texts)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": np.r_[at, -1].astype(np.int32), "n": np.r_[total[at], rows]})

    ship(docs.sparkSession)
    # TERMS + 1 rows
    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(TERMS, np.int64)
    real = found["term"] >= 0
    counts[found["term"][real]] = found["n"][real]
    return counts, int(found["n"][~real].sum())


def values(owner: np.ndarray, term: np.ndarray, times: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Damped counts by rarity, of length 1 each. owner: sorted."""
    v = np.log2(1.0 + times) * weight[term]
    size = np.sqrt(np.bincount(owner, v * v, n))
    return v / np.maximum(size, 1e-12)[owner]


def projected(owner: np.ndarray, term: np.ndarray, value: np.ndarray, basis: np.ndarray, n: int) -> np.ndarray:
    """n rows of latent vectors of length 1 (0 for texts of no term)."""
    out = np.zeros((n, basis.shape[1]), np.float32)
    for at in range(0, n, BLOCK):
        i, j = np.searchsorted(owner, [at, at + BLOCK])
        dense = np.zeros((min(BLOCK, n - at), len(basis)), np.float32)
        dense[owner[i:j] - at, term[i:j]] = value[i:j]
        out[at : at + BLOCK] = dense @ basis
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def singular_vectors(owner: np.ndarray, term: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """The leading right singular vectors of the sparse matrix, by subspace iteration over blocks of rows."""
    rng = np.random.default_rng(7)
    basis = np.linalg.qr(rng.standard_normal((TERMS, RANK + 8)))[0].astype(np.float32)
    for _ in range(STEPS):
        new = np.zeros_like(basis)
        for at in range(0, n, BLOCK):
            i, j = np.searchsorted(owner, [at, at + BLOCK])
            dense = np.zeros((min(BLOCK, n - at), TERMS), np.float32)
            dense[owner[i:j] - at, term[i:j]] = value[i:j]
            new += dense.T @ (dense @ basis)
        q, r = np.linalg.qr(new)
        basis = q.astype(np.float32)
    order = np.argsort(-np.abs(np.diag(r)), kind="stable")[:RANK]
    return basis[:, order]


@dataclass(frozen=True)
class Model:
    """weight: of each term; basis: terms by dimensions; vectors, labels, stands_for: the labelled rows, and how many each stands for; rate: of label 1."""

    weight: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    stands_for: np.ndarray
    rate: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        n = len(texts)
        if not len(self.labels):
            return np.full(n, self.rate)
        owner, term, times = terms(texts)
        rows = projected(owner, term, values(owner, term, times, self.weight, n), self.basis, n)
        out = np.empty(n)
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, n, BLOCK):
            # rounded, so that equal texts are equally near wherever they stand
            near = np.round(rows[at : at + BLOCK] @ self.vectors.T, 4)
            least = np.partition(near, -k, axis=1)[:, -k][:, None]
            text, row = np.nonzero((near >= least) & (near > 0))
            vote = near[text, row].astype(np.float64) ** POWER * self.stands_for[row]
            good, votes = (np.bincount(text, v, len(near)) for v in (vote * self.labels[row], vote))
            out[at : at + BLOCK] = (good + PRIOR * self.rate) / (votes + PRIOR)
        return out


def sample(train: DataFrame) -> DataFrame:
    """label, text: of each label MAX_ROWS documents at most, lowest hash of the id first, and one row of each, that of the least text hash."""
    ids = train.select("label", "doc_id").distinct()
    first = lambda k: ids.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_ROWS)
    chosen = train.join(F.broadcast(first(0).union(first(1))), ["label", "doc_id"], "left_semi")  # 2 * MAX_ROWS ids at most
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))
    return chosen.groupBy("label", "doc_id").agg(least.alias("least")).select("label", "doc_id", F.xxhash64("doc_id").alias("hash"), "least.text")


def fit(train: DataFrame, corpus: DataFrame) -> Model:
    """train: doc_id, text, label 0 or 1; corpus: text, of all documents. Without labels every score is 0.5."""
    counts, n_docs = document_counts(corpus)
    weight = np.log((1.0 + n_docs) / (1.0 + counts))
    rates = {r.label: r.n for r in train.groupBy("label").agg(F.count_distinct("doc_id").alias("n")).collect()}  # two rows
    rate = rates.get(1, 0) / max(sum(rates.values()), 1) if rates else 0.5

    def run(batches):
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                owner, term, times = terms(texts.to_pylist())
                cuts = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
                lists = {name: pa.ListArray.from_arrays(cuts, pa.array(v, pa.int32())) for name, v in (("terms", term), ("times", times))}
                yield pa.RecordBatch.from_pydict({**{c: batch.column(c).slice(at, len(texts)) for c in ("label", "hash", "doc_id")}, **lists})
                at += len(texts)

    rows = sample(train).mapInArrow(run, "label int, hash long, doc_id long, terms array<int>, times array<int>").toPandas()
    rows = rows.sort_values(["label", "hash", "doc_id"]).reset_index(drop=True)
    rows["place"] = rows.groupby("label").cumcount()
    n = len(rows)
    owner = np.repeat(np.arange(n), [len(x) for x in rows["terms"]])
    flat = lambda c: np.concatenate([*rows[c], np.zeros(0, np.int64)]).astype(np.int64)
    term = flat("terms")
    value = values(owner, term, flat("times"), weight, n)
    labels = rows["label"].to_numpy(np.float64)
    if not n:
        return Model(weight, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, labels, rate)
    basic = np.flatnonzero(rows["place"] < BASIS_ROWS)
    i, j = np.searchsorted(owner, basic), np.searchsorted(owner, basic, "right")
    part = np.concatenate([np.arange(a, b) for a, b in zip(i, j, strict=True)])
    basis = singular_vectors(np.repeat(np.arange(len(basic)), j - i), term[part], value[part], len(basic))
    each = np.array([rates.get(k, 0) / max((labels == k).sum(), 1) for k in (0, 1)])
    return Model(weight, basis, projected(owner, term, value, basis, n), labels, each[labels.astype(int)], rate)


def score(df: DataFrame, model: Model, text: str = "text", into: str = "quality") -> DataFrame:
    """df with a struct column: score (0 to 1), predicted. A column of that name is replaced, others stay whatever their names.

    Null and empty texts, and texts like no labelled one, get the rate of label 1 in all training rows. Equal texts get equal scores.
    Long texts are read whole; an empty df gives no rows.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)  # bounded by TERMS, RANK and MAX_ROWS

    def make():
        own = sent.value

        def work(texts: list) -> pa.Array:
            s = np.concatenate([own.score(texts[i : i + BLOCK]) for i in range(0, len(texts), BLOCK)])
            return struct_of(score=s, predicted=(s >= THRESHOLD).astype(np.int32))

        return work

    return df.withColumn(into, text_column("score double, predicted int", make)(F.col(text)))


def training_rows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, label, written to the shared folder. A document with several label rows is good if all of them
    say so; null labels, ids and texts teach nothing. Of more than MAX_LABELS documents about so many are taken."""
    marks = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    rows = documents.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(rows.join(at_most(marks, MAX_LABELS), "doc_id"), "quality-train")


#: Labelled documents that are learned from, at most (24 bytes each, broadcast); of more, those of the lowest hashes.
MAX_LABELS = 1_000_000
