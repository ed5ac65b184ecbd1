"""Text quality: random-indexing word vectors pooled per document, then a two-layer network with calibrated probabilities.

Random indexing gives every word a sparse random index vector; the vector of a word is the sum
of the index vectors of its neighbours in the fit texts, to which its own is added. A document is the weighted mean
of its words' vectors. The network is fitted on a bounded sample of labelled documents
(``FIT_ROWS``) and its probabilities are calibrated by one temperature on labelled documents that
the network has not seen. Scores are computed for every whole text, in one narrow pass.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.work import Work

#: Most labelled documents of each class in the fit.
FIT_ROWS = 3_000
#: Most words with a vector of their own, and how often such a word occurs at least in the fit texts.
VOCABULARY, LEAST_COUNT = 20_000, 4
DIM, NONZERO, WINDOW = 128, 8, 2
#: A word of this share of all words counts half as much as a rare one.
RARITY = 1e-2
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 128, 3e-3, 1e-4
FIT_PARTS = 8
#: Words whose sums of neighbours travel together: half a megabyte.
STRIP = 512
THRESHOLD = 0.7
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
#: Stand-ins: for a repetition, then for words without a vector by their form.
AGAIN, FORMS = 0, 7


def _form(token: str) -> int:
    if token.isdigit():
        return 1
    if token.isalpha():
        if token.islower():
            return 2
        return 3 if token.isupper() and len(token) > 1 else 4
    return 5 if token.isalnum() else 6


def token_ids(text: str, known: dict[str, int]) -> np.ndarray:
    """Numbers of the words and symbol runs of ``text``, then one ``AGAIN`` for each word that repeats the one before it.

    The first ``FORMS`` numbers are stand-ins.
    """
    found = _TOKEN.findall(text)
    if not found:
        return np.empty(0, np.int64)
    get, words = known.get, text.split()
    ids = np.array([get(t) or _form(t) for t in found], np.int64)
    again = sum(map(eq, words, words[1:]))
    return np.concatenate([ids, np.full(again, AGAIN)]) if again else ids


def index_vectors(size: int, dim: int = DIM, nonzero: int = NONZERO) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of ``size`` sparse random vectors."""
    rng = np.random.default_rng(size * 31 + dim)
    return rng.integers(0, dim, (size, nonzero)), rng.choice([-1.0, 1.0], (size, nonzero))


def _add_neighbours(total: np.ndarray, ids: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Add the index vectors of the neighbours up to ``WINDOW`` words away to the row of each word."""
    size, dim = total.shape
    for apart in range(1, WINDOW + 1):
        for word, near in ((ids[apart:], ids[:-apart]), (ids[:-apart], ids[apart:])):
            for k in range(places.shape[1]):
                total += np.bincount(word * dim + places[near, k], signs[near, k], size * dim).reshape(size, dim)


class Model:
    """Vectors and network; ``score`` gives the probability of label 1 for each text."""

    def __init__(self, words: list[str], vectors: np.ndarray, weights: np.ndarray) -> None:
        self.known = {w: FORMS + k for k, w in enumerate(words)}
        self.vectors = np.multiply(vectors, weights[:, None], out=np.empty(vectors.shape, np.float32), casting="same_kind")
        self.weights = weights.astype(np.float32)
        self.net: dict[str, np.ndarray] = {}
        self.temperature = 1.0
        self.constant: float | None = None

    @classmethod
    def of(cls, state: dict) -> Model:
        """Model from its plain attributes, the form in which it travels."""
        model = cls.__new__(cls)
        model.__dict__.update(state)
        return model

    def pooled(self, texts) -> np.ndarray:
        """Weighted mean vector of each text; without words, zeros."""
        out = np.zeros((len(texts), DIM))
        for row, text in enumerate(texts):
            ids = token_ids(text or "", self.known)
            if len(ids):
                used, times = np.unique(ids, return_counts=True)
                out[row] = times.astype(np.float32) @ self.vectors[used] / (times @ self.weights[used])
        return out

    def logits(self, x: np.ndarray) -> np.ndarray:
        n = self.net
        hidden = np.tanh((x - n["mean"]) / n["spread"] @ n["w1"] + n["b1"])
        return hidden @ n["w2"] + n["b2"]

    def score(self, texts) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(self.pooled(texts)) / self.temperature, -60, 60)))


def fit_network(model: Model, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
    """Two layers by Adam on four fifths of the rows, then the temperature on the rest; ``weight`` undoes the class sampling."""
    rng = np.random.default_rng(5)
    order = rng.permutation(len(y))
    held, used = order[: len(y) // 5], order[len(y) // 5 :]
    if len(np.unique(y[held])) < 2 or len(np.unique(y[used])) < 2:
        held = used = order
    n = model.net
    n["mean"], n["spread"] = x[used].mean(axis=0), x[used].std(axis=0) + 1e-3
    n["w1"], n["b1"] = rng.normal(0, DIM**-0.5, (DIM, HIDDEN)), np.zeros(HIDDEN)
    n["w2"], n["b2"] = rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)
    names = ("w1", "b1", "w2", "b2")
    first, second = ({k: np.zeros_like(n[k]) for k in names} for _ in range(2))
    z, step = (x - n["mean"]) / n["spread"], 0
    for _ in range(EPOCHS):
        used = rng.permutation(used)
        for at in range(0, len(used), BATCH):
            rows = used[at : at + BATCH]
            hidden = np.tanh(z[rows] @ n["w1"] + n["b1"])
            p = 1 / (1 + np.exp(-np.clip(hidden @ n["w2"] + n["b2"], -60, 60)))
            slope = weight[rows] * (p - y[rows]) / weight[rows].sum()
            back = slope[:, None] * n["w2"] * (1 - hidden**2)
            grad = {"w1": z[rows].T @ back + DECAY * n["w1"], "b1": back.sum(axis=0), "w2": hidden.T @ slope + DECAY * n["w2"], "b2": slope.sum(keepdims=True)}
            step += 1
            for k in names:
                first[k] = 0.9 * first[k] + 0.1 * grad[k]
                second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
                n[k] = n[k] - RATE * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    logits = model.logits(x[held])
    best = np.inf
    for t in np.geomspace(0.25, 8, 61):
        margin = np.clip(np.where(y[held] > 0, logits, -logits) / t, -60, 60)
        loss = float((weight[held] * np.log1p(np.exp(-margin))).sum())
        if loss < best:
            best, model.temperature = loss, float(t)


def fit(docs: DataFrame, labels: DataFrame, work: Work, fit_rows: int = FIT_ROWS) -> Model:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality 0 or 1).

    The fit sees at most ``fit_rows`` documents per class, those whose id hashes lowest. Ids without
    label, with a null label or with both labels are not learnt from. Without two classes the model gives the share of label 1, without labels 0.5.
    """
    marked = (
        labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"), F.max("quality").cast("int").alias("top"))
        .filter("quality = top")
        .select("doc_id", "quality")
    )
    marked = work.settle(marked.join(docs.select("doc_id").filter("doc_id IS NOT NULL").distinct(), "doc_id", "left_semi"), "labels")
    sizes = {r.quality: r.n for r in marked.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        model = Model([], np.zeros((FORMS, DIM)), np.ones(FORMS))
        model.constant = float(next(iter(sizes), 0.5))
        return model
    picked = None
    for quality in (0, 1):
        part = marked.filter(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
        picked = part if picked is None else picked.unionByName(part)
    picked = work.settle(picked, "picked")  # at most twice fit_rows ids: small enough to send to every task
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").repartition(FIT_PARTS, "doc_id")
    sample = work.settle(sample.dropDuplicates(["doc_id"]), "sample")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for part in parts:
            for text in part.column("text").to_pylist():
                found.update(_TOKEN.findall(text or ""))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    frequent = (
        sample.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= LEAST_COUNT).orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()
    )
    words = [r.word for r in frequent]
    known, size = {w: FORMS + k for k, w in enumerate(words)}, FORMS + len(words)

    def neighbours(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors(size)
        total, counts = np.zeros((size, DIM)), np.zeros(size)
        held: list[np.ndarray] = []

        def add() -> None:
            if held:
                ids = np.concatenate(held)
                _add_neighbours(total, ids, places, signs)
                counts[:] += np.bincount(ids, minlength=size)
                held.clear()

        for part in parts:
            for text in part.column("text").to_pylist():
                held.append(token_ids(text or "", known))
            if sum(map(len, held)) > 1_000_000:
                add()
        add()
        for at in range(0, size, STRIP):
            if counts[at : at + STRIP].any():  # a word without a place has no neighbours
                cells = [pa.array([at]), *(pa.array([x[at : at + STRIP].tobytes()], pa.binary()) for x in (total, counts))]
                yield pa.RecordBatch.from_arrays(cells, ["first", "total", "counts"])

    def added(group: pa.Table) -> pa.Table:
        sums = [np.sum([np.frombuffer(b) for b in group.column(c).to_pylist()], axis=0) for c in ("total", "counts")]
        return pa.table([group.column("first").slice(0, 1), *(pa.array([x.tobytes()], pa.binary()) for x in sums)], ["first", "total", "counts"])

    # tasks add up whole numbers, so their order changes nothing; the driver gets each strip once
    strip = "first long, total binary, counts binary"
    strips = sample.select("text").coalesce(FIT_PARTS).mapInArrow(neighbours, strip).groupBy("first").applyInArrow(added, strip)
    vectors, counts = np.zeros((size, DIM)), np.zeros(size)
    for r in strips.coalesce(FIT_PARTS).toLocalIterator():
        found = np.frombuffer(r.counts)
        vectors[r.first : r.first + len(found)] = np.frombuffer(r.total).reshape(-1, DIM)
        counts[r.first : r.first + len(found)] = found
    places, signs = index_vectors(size)
    for at in range(0, size, STRIP):
        some, own = vectors[at : at + STRIP], np.zeros((min(STRIP, size - at), DIM))
        some /= np.linalg.norm(some, axis=1, keepdims=True) + 1e-9
        np.add.at(own, (np.arange(len(own))[:, None], places[at : at + STRIP]), signs[at : at + STRIP])
        some += own / np.sqrt(NONZERO)
    share = (counts + 1) / (counts.sum() + size)
    model = Model(words, vectors, RARITY / (RARITY + share))
    del vectors
    carried = work.spark.sparkContext.broadcast(vars(model))

    def features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Model.of(carried.value)
        for part in parts:
            x = made.pooled(part.column("text").to_pylist()).astype(np.float32)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), pa.array([v.tobytes() for v in x], pa.binary())], ["doc_id", "quality", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = sample.select("doc_id", "quality", "text").mapInArrow(features, f"doc_id {kind}, quality int, x binary").collect()
    carried.destroy()
    rows.sort(key=lambda r: str(r.doc_id))
    y = np.array([r.quality for r in rows], float)
    # the classes are sampled apart: weights bring their shares back
    whole = np.array([sizes[int(v)] / max(1, (y == v).sum()) for v in y])
    fit_network(model, np.frombuffer(b"".join(r.x for r in rows), np.float32).reshape(-1, DIM).astype(float), y, whole / whole.mean())
    return model


def scorer(model: Model, work: Work):
    """Column function: the score of a text column."""
    carried = work.spark.sparkContext.broadcast(vars(model))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(Model.of(carried.value).score(texts.tolist()), dtype="float64")

    return score


def fold(doc_id: Column, parts: int) -> Column:
    return F.crc32(doc_id.cast("string")) % parts


def score_documents(docs: DataFrame, labels: DataFrame, work: Work, learn: Column | None = None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` (doc_id, text, others kept) with ``score`` in 0 to 1 and ``predicted`` (1 from 0.7 on); columns of these names are replaced.

    Learns from the labels of rows for which ``learn`` holds. A null text is empty; texts without
    words get the score of the zero vector. Rows that repeat score alike, a null doc_id is scored and
    not learnt from, an empty table gives no rows.
    """
    usable = labels.select("doc_id", "quality")
    if learn is not None:
        usable = usable.filter(learn)
    score = scorer(fit(docs, usable, work, fit_rows), work)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    scored = docs.select(*others, score(F.col("text").cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
