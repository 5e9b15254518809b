"""Toxicity by a classifier chain.

Each category has a logistic regression over sparse features, the words of a document and
their beginnings; the chain feeds the probabilities of earlier categories to later ones.
In training those probabilities are out of fold, so a link learns from such as it will see.

The models are fitted on at most ``max_train`` labelled documents, taken by hash. Feature
counts come from Spark; the driver gets the selected features of that sample alone (at most
``max_train`` x ``n_features`` bits), and every document is scored in its own task.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

MAX_TRAIN = 4_000
N_FEATURES = 512
MAX_LANGUAGES = 16
FOLDS = 4
BEGINNINGS = (3, 4, 5, 6, 7)
CACHE = 500_000


def features(word: str) -> list[int]:
    """Hashes of the word and of its beginnings, marked by length."""
    w = word.strip(".,;:!?|\"'()[]").lower()
    if not w:
        return []
    parts = [w + "$", *(w[:n] for n in BEGINNINGS if len(w) > n)]
    return [xxhash.xxh3_64_intdigest(p.encode("utf-8", "surrogatepass")) - 2**63 for p in parts]


class Known(dict):
    """Word to its selected features; bounded."""

    def __init__(self, index: dict[int, int]) -> None:
        super().__init__()
        self.index = index

    def __missing__(self, word: str) -> tuple[int, ...]:
        got = tuple(i for f in features(word) if (i := self.index.get(f)) is not None)
        if len(self) >= CACHE:
            self.clear()
        self[word] = got
        return got

    def of(self, text: str) -> list[int]:
        found: set[int] = set()
        for word in set(text.split()):
            if got := self[word]:
                found.update(got)
        return sorted(found)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 150) -> np.ndarray:
    """Weights, the intercept last: accelerated gradient descent on the mean log loss with an L2
    penalty, classes weighted to be even. All zero but a low intercept if a class is missing."""
    n, d = x.shape
    w = np.zeros(d + 1, dtype=np.float32)
    if not 0 < y.sum() < n:
        w[-1] = -8.0
        return w
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (n - y.sum())).astype(np.float32)
    v = np.random.default_rng(1).normal(size=d).astype(np.float32)
    for _ in range(10):  # the largest curvature, for the step
        v = x.T @ (weight * (x @ v))
        v /= (norm := np.linalg.norm(v)) or 1
    rate = 1 / (0.25 * (norm + 1) * 1.2 + penalty / n)
    momentum = w.copy()
    for t in range(steps):
        error = weight * (sigmoid(x @ momentum[:-1] + momentum[-1]) - y)
        gradient = np.concatenate([x.T @ error + penalty / n * momentum[:-1], [error.sum()]]).astype(np.float32)
        new = momentum - rate * gradient
        momentum = new + t / (t + 3) * (new - w)
        w = new
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1]).astype(np.float32)


def fit_chain(x: np.ndarray, y: np.ndarray, fold: np.ndarray, folds: int = FOLDS) -> list[np.ndarray]:
    """Weights of each link over features, then probabilities of earlier links."""
    links = []
    for j in range(y.shape[1]):
        links.append(logistic(x, y[:, j]))
        if j + 1 < y.shape[1]:
            out = np.zeros(len(x), dtype=np.float32)
            for f in range(folds):
                held = fold == f
                out[held] = probability(x[held], logistic(x[~held], y[~held, j]))
            x = np.hstack([x, out[:, None]])
    return links


def _seen(m: int):
    """Distinct features of each task's documents with their counts, in all and by category."""

    def run(batches):
        found, labels = [], []
        for b in batches:
            y = np.stack([b.column(f"y{j}").to_numpy(zero_copy_only=False) for j in range(m)], axis=1)
            for text, row in zip(b.column("text").to_pylist(), y, strict=True):
                own = {f for word in set(text.split()) for f in features(word)}
                found.append(np.fromiter(own, dtype=np.int64, count=len(own)))
                labels.append(np.repeat(np.concatenate([[1], row])[None], len(own), axis=0))
        if found:
            ids, at = np.unique(np.concatenate(found), return_inverse=True)
            counts = [np.bincount(at, c, len(ids)).astype(np.int64) for c in np.concatenate(labels).T]
            yield pa.RecordBatch.from_arrays([pa.array(ids), *map(pa.array, counts)], ["f", "n", *(f"c{j}" for j in range(m))])

    return run


class Chain:
    """Categories with their links; picklable, a few hundred kB."""

    def __init__(self, categories: list[str], index: dict[int, int], links: list[np.ndarray]) -> None:
        self.categories, self.index, self.links = categories, index, links

    def score(self, texts: list[str], known: Known) -> np.ndarray:
        out = np.zeros((len(texts), len(self.links)), dtype=np.float32)
        n = len(self.index)
        for r, text in enumerate(texts):
            own = known.of(text)
            for j, w in enumerate(self.links):
                z = w[own].sum() + w[n : n + j] @ out[r, :j] + w[-1]
                out[r, j] = sigmoid(z)
        return out


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, n_features: int = N_FEATURES) -> Chain:
    """A chain over the categories of ``labels`` (doc_id, then a 0/1 column for each, in the chain's
    order). Rows with a null label or text are left out; no usable rows give a chain that finds nothing."""
    categories = [c for c in labels.columns if c != "doc_id"]
    m = len(categories)
    named = labels.select("doc_id", *(labels[c].cast("int").alias(f"y{j}") for j, c in enumerate(categories)))
    named = named.dropna().dropDuplicates(["doc_id"])
    present = docs.where(F.col("text").isNotNull()).select("doc_id")
    usable = named.join(present, "doc_id", "left_semi").withColumn("order", F.xxhash64("doc_id"))
    chosen = common.least_hashes(usable, usable.count(), F.col("order"), max_train)
    sample = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    sample = common.written(sample.join(F.broadcast(chosen), "doc_id"), "train").repartition(8, "order")  # max_train rows
    schema = ", ".join(["f long", "n long", *(f"c{j} long" for j in range(m))])
    score: Column = F.lit(-1e9)
    for j in range(m):  # log-odds of a category where the feature is, in standard errors
        a, b = F.col(f"c{j}") + 0.5, F.col("n") - F.col(f"c{j}") + 0.5
        score = F.greatest(score, F.log(a / b) / F.sqrt(1 / a + 1 / b))
    sums = [F.sum(c).alias(c) for c in ("n", *(f"c{j}" for j in range(m)))]
    counted = sample.select("text", *(f"y{j}" for j in range(m))).mapInArrow(_seen(m), schema).groupBy("f").agg(*sums)
    chosen = counted.where("n >= 4").withColumn("score", score).orderBy(F.desc("score"), "f").limit(n_features).collect()
    index = {r["f"]: i for i, r in enumerate(chosen)}

    def rows(batches):
        known = Known(index)
        for b in batches:
            own = [known.of(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("order"), pa.array(own, pa.list_(pa.int32())), *(b.column(f"y{j}") for j in range(m))],
                ["order", "own", *(f"y{j}" for j in range(m))],
            )

    out = ", ".join(["order long", "own array<int>", *(f"y{j} int" for j in range(m))])
    got = sample.select("order", "text", *(f"y{j}" for j in range(m))).mapInArrow(rows, out).toArrow().sort_by("order")
    x = np.zeros((len(got), len(index)), dtype=np.float32)
    for r, own in enumerate(got.column("own").to_pylist()):
        x[r, own] = 1
    y = np.array([got.column(f"y{j}").to_numpy() for j in range(m)], dtype=np.float32).T.reshape(len(got), m)
    return Chain(categories, index, fit_chain(x, y, np.arange(len(got)) % FOLDS))


def classify(docs: DataFrame, chain: Chain, threshold: float = 0.5) -> DataFrame:
    """row (the columns given), probabilities (of each category, in the chain's order), toxic (the last one's
    is at least ``threshold``). Null texts are empty. Each row is scored alone, whole."""
    broadcast = docs.sparkSession.sparkContext.broadcast(chain)
    job = uuid.uuid4().hex

    def run(batches):
        chain = broadcast.value
        known = common.kept("toxicity", job, lambda: Known(chain.index))
        for b in batches:
            p = chain.score(b.column("text").to_pylist(), known)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(list(p.astype(np.float64)), pa.list_(pa.float64())), pa.array(p[:, -1] >= threshold)],
                ["row", "probabilities", "toxic"],
            )

    own = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.coalesce("text", F.lit("")).alias("text")
    )
    kind = own.schema["row"].dataType.simpleString()
    return own.mapInArrow(run, f"row {kind}, probabilities array<double>, toxic boolean")


def categories(docs: DataFrame, labels: DataFrame, least: int = 5, max_languages: int = MAX_LANGUAGES) -> DataFrame:
    """doc_id, toxicity by language (languages with at least ``least`` toxic documents, most first, at most
    ``max_languages`` of them: each is a link of the chain), toxic. Others count in the last link, as all do.

    The table has one toxicity label; abuse in each language has words of its own, so these are
    the categories, and toxicity as such is the last link."""
    named = labels.select("doc_id", "toxic").join(docs.select("doc_id", "lang"), "doc_id").where("toxic is not null")
    langs = named.where("toxic = 1 and lang is not null").groupBy("lang").count().where(F.col("count") >= least)
    langs = [r[0] for r in langs.orderBy(F.desc("count"), "lang").limit(max_languages).collect()]
    return named.select(
        "doc_id", *(((F.col("toxic") == 1) & (F.col("lang") == x)).cast("int").alias(f"toxic_{x}") for x in langs), "toxic"
    )


def op9_toxicity_chain(spark, sf_dir) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    chain = fit(docs, categories(docs, common.table(spark, sf_dir, "labels")))
    return classify(docs, chain).select(
        "row.doc_id",
        F.array_join(F.array(*(F.lit(c) for c in chain.categories)), ",").alias("categories"),
        F.transform("probabilities", lambda p: F.round(p, 6)).alias("probabilities"),
        "toxic",
    )
