"""Benchmark decontamination by latent semantic retrieval.

1. Words of all documents become hashed features; their document frequency is counted over
   passages of ``PASSAGE`` words of the whole corpus.
2. A randomised SVD of the TF-IDF matrix A of all passages: for a random orthonormal Q
   (features x RANK) tasks add up their part of Y = A^T A Q in one pass over A, and
   Y (Q^T Y)^-1 Y^T stands for A^T A (Nystroem), whose singular values and vectors follow.
   What meets on the driver is features x RANK numbers, whatever the corpus.
3. Documents are folded in: windows of several lengths, every ``STEP`` words, become vectors
   in the space of singular vectors, scaled by the singular values; so do benchmark items.
   Pairs of a cosine of at least ``COSINE`` are candidates. A cosine doesn't bound what two
   texts share in words, so items of which a document has enough words are candidates too, of
   any length: no window of ``reach`` words that makes a leak is lost.
4. Candidates are checked on words: the longest common subsequence of item and window has to
   cover most of the item, or a little less with most of its answer (the last sentence).
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

FEATURES, BLOCK = 1 << 14, 1 << 8
RANK, PASSAGE, STEP = 64, 32, 4
#: The leading directions tell languages and registers apart, not passages.
COMMON = 8
#: Windows: length and stride, in steps. Each is for items of 0.6 to 1.6 times its words, the first for
#: shorter ones too, the last for longer ones, which it meets in part.
WINDOWS = ((4, 1), (8, 2), (14, 3))
COSINE = 0.62
COVERED, NEARLY, ANSWER = 0.75, 0.6, 0.8
MAX_ITEMS = 100_000
CACHE = 500_000
AT_ONCE = 25_600
#: Cells of texts and items that are counted at once.
COUNTED = 4_000_000
#: Items whose cosines are computed at once.
ITEMS = 4_096


#: Each feature as two bytes, of which a worker keeps one copy.
BYTES = [f.to_bytes(2, sys.byteorder) for f in range(FEATURES)]


def small_ascii(text: str) -> str:
    """The text with small ASCII letters; ``normal`` gives the same for its words, which have fewer spellings."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def normal(word: str) -> str:
    return word.strip(".,;:!?|\"'()[]{}<>*_-").lower()


class Features(dict):
    """Raw word to feature, as two bytes; bounded. Marks alone are feature 0, which has no weight."""

    def __missing__(self, word: str) -> bytes:
        w = normal(word)
        f = 1 + xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) % (FEATURES - 1) if w else 0
        if len(self) >= CACHE:
            self.clear()
        self[word] = BYTES[f]
        return BYTES[f]

    def bytes_of(self, words: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, words))

    def of(self, words: list[str]) -> np.ndarray:
        return np.frombuffer(self.bytes_of(words), dtype=np.uint16)


def _kept_features() -> Features:
    return common.kept("features", None, Features)


def _ids(batches):
    features = _kept_features()
    for b in batches:
        rows = [features.bytes_of(small_ascii(t).split()) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(rows, pa.binary())], ["row", "ids"])


def featured(docs: DataFrame) -> DataFrame:
    """row (the columns given), ids (features of the words), written: texts are cut into words once."""
    own = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    return common.written(own.mapInArrow(_ids, f"row {own.schema['row'].dataType.simpleString()}, ids binary"), "features")


def _padded(batch):
    """The passages of a batch's texts, one row each, in parts of bounded size; a text's last one is filled up with
    feature 0."""
    held, size = [], 0
    for ids in batch.column("ids").to_pylist():
        f = np.frombuffer(ids, dtype=np.uint16)
        for at in range(0, len(f), AT_ONCE):  # a multiple of PASSAGE
            part = f[at : at + AT_ONCE]
            held += [part, np.zeros(-len(part) % PASSAGE, dtype=np.uint16)]
            size += len(part) + len(held[-1])
            if size >= AT_ONCE:
                yield np.concatenate(held).reshape(-1, PASSAGE)
                held, size = [], 0
    if held:
        yield np.concatenate(held).reshape(-1, PASSAGE)


def _frequencies(batches):
    n, total = np.zeros(FEATURES, dtype=np.int64), 0
    for b in batches:
        for feature in _padded(b):
            feature.sort(axis=1)
            new = np.ones(feature.shape, dtype=bool)
            new[:, 1:] = feature[:, 1:] != feature[:, :-1]
            n += np.bincount(feature[new], minlength=FEATURES)
            total += len(feature)
    n[0] = total
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["feature", "n"])


def _product(weights, basis):
    """The task's part of A^T A basis, in blocks of features. A row is a passage: the weights of its words'
    occurrences over the root of their sum of squares."""

    def run(batches):
        idf = weights.value
        q = idf[:, None] * basis.value
        out = np.zeros(q.shape[::-1])
        for b in batches:
            for feature in _padded(b):
                square = np.maximum((idf[feature] ** 2).sum(axis=1), 1e-9)
                rows = (q[feature].sum(axis=1) / square[:, None]).T.astype(np.float64)
                words = feature.ravel().astype(np.int64)
                for own, row in zip(out, rows, strict=True):
                    own += np.bincount(words, weights=np.repeat(row, PASSAGE), minlength=FEATURES)
        out = np.ascontiguousarray((out * idf).T, dtype=np.float32)
        yield _blocks_batch({i: out[i * BLOCK : i * BLOCK + BLOCK] for i in range(FEATURES // BLOCK)})

    return run


def _blocks_batch(blocks: dict[int, np.ndarray]) -> pa.RecordBatch:
    cols = [pa.array(list(blocks), pa.int32()), pa.array([x.tobytes() for x in blocks.values()], pa.binary())]
    return pa.RecordBatch.from_arrays(cols, ["block", "part"])


def _added(rank: int):
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, x in zip(b.column("block").to_pylist(), b.column("part").to_pylist(), strict=True):
                x = np.frombuffer(x, dtype=np.float32).reshape(-1, rank)
                total[i] = total[i] + x if i in total else x
        yield _blocks_batch(total)

    return run


def _times(ids: DataFrame, weights, q: np.ndarray) -> np.ndarray:
    """A^T A q: parts of tasks meet by block, so no task adds more than its blocks, one after another."""
    sc = ids.sparkSession.sparkContext
    schema, n = "block int, part binary", FEATURES // BLOCK
    parts = ids.mapInArrow(_product(weights, sc.broadcast(q.astype(np.float32))), schema)
    sums = parts.repartition(n, "block").mapInArrow(_added(q.shape[1]), schema).collect()
    out = np.zeros(q.shape, dtype=np.float64)
    for i, x in sums:
        out[i * BLOCK : i * BLOCK + BLOCK] = np.frombuffer(x, dtype=np.float32).reshape(-1, q.shape[1])
    return out


def fold(ids: DataFrame, rank: int = RANK, iterations: int = 1) -> np.ndarray:
    """Features x (rank - COMMON): what an occurrence of each feature adds to a text's latent vector. ``ids``: the
    features of all documents; each iteration is a pass over them."""
    counts = ids.mapInArrow(_frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n")).collect()
    n = np.zeros(FEATURES)
    for f, c in counts:  # at most one row for each feature
        n[f] = c
    idf = np.where(n > 0, np.log((n[0] + 1) / np.maximum(n, 1)) + 0.1, 0).astype(np.float32)
    idf[0] = 0
    weights = ids.sparkSession.sparkContext.broadcast(idf)
    q = np.linalg.qr(np.random.default_rng(7).normal(size=(FEATURES, rank)))[0]
    for _ in range(iterations - 1):  # more of them bring the values of a flat spectrum nearer to the exact ones
        q = np.linalg.qr(_times(ids, weights, q))[0]
    y = _times(ids, weights, q)
    inner, turn = np.linalg.eigh((q.T @ y + y.T @ q) / 2)
    root = y @ turn / np.sqrt(np.maximum(inner, 1e-9 * max(inner.max(), 1e-9)))  # A^T A is about root root^T
    squares, turn = np.linalg.eigh(root.T @ root)
    squares = np.maximum(squares, 1e-9 * max(squares.max(), 1e-9))
    space = (idf[:, None] * (root @ turn) / squares)[:, : rank - COMMON]  # ascending: the leading ones are last
    return np.ascontiguousarray(space, dtype=np.float32)


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, bits of an integer for the words of ``a``."""
    at: dict = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for w in b:
        if m := at.get(w):
            u = s & m
            s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def _spans(sizes: list[int], most: int):
    """Consecutive ranges (first, end) of a list whose ``sizes`` add up to ``most``, or a little more."""
    low, size = 0, 0
    for i, n in enumerate(sizes):
        size += n
        if size >= most or i == len(sizes) - 1:
            yield low, i + 1
            low, size = i + 1, 0


class Items:
    """Benchmark items with their words, answers and unit latent vectors."""

    def __init__(self, rows: list[tuple[int, str]], space: np.ndarray) -> None:
        features = Features()
        self.ids, self.words, self.features, self.answers, vectors = [], [], [], [], []
        for item_id, text in rows:
            words = [w for x in text.split() if (w := normal(x))]
            if not words:
                continue
            last = [s for s in text.replace("\n", " ").split(". ") if s.strip()][-1]
            answer = [w for x in last.split() if (w := normal(x))]
            self.ids.append(item_id)
            self.words.append(words)
            self.features.append(features.of(words).tolist())
            self.answers.append(answer if 3 <= len(answer) < len(words) else words[-max(len(words) // 4, 1) :])
            vectors.append(space[features.of(text.split())].sum(axis=0))
        v = np.array(vectors, dtype=np.float32).reshape(len(vectors), space.shape[1])
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
        size = np.array([len(w) for w in self.words], dtype=np.int64)
        self.vectors, self.size = v, size
        #: Postings: items of each feature and how often they have it.
        cells, n = np.unique(
            np.concatenate([np.zeros(0, dtype=np.int64), *(np.array(f, dtype=np.int64) * len(v) + i for i, f in enumerate(self.features))]),
            return_counts=True,
        )
        self.posted, self.times = cells % max(len(v), 1), n
        self.start = np.searchsorted(cells, np.arange(FEATURES + 1) * len(v))
        self.posts = np.diff(self.start) > 0
        self.posts[0] = False
        self.parts = []  # for each kind of window: numbers and vectors of its items
        for k, (length, _) in enumerate(WINDOWS):
            low = 0 if k == 0 else 0.6 * length * STEP
            high = np.inf if k == len(WINDOWS) - 1 else 1.6 * length * STEP
            own = np.flatnonzero((size >= low) & (size <= high))
            self.parts.append((own, np.ascontiguousarray(v[own].T)))

    def reach(self, i: int) -> int:
        """Words of a window in which the item may be."""
        return max(len(self.words[i]) * 5 // 4, 4 * STEP) + 2 * STEP

    def shared(self, texts: list[np.ndarray]) -> np.ndarray:
        """Of which items each text has at least the share ``NEARLY`` of words, in any order: text * items + item."""
        items, out = len(self.size), [np.zeros(0, dtype=np.int64)]
        at_once = max(1, COUNTED // max(items, 1))
        for low in range(0, len(texts), at_once):
            own = texts[low : low + at_once]
            text = np.repeat(np.arange(len(own)), [len(x) for x in own])
            ids = np.concatenate(own)
            posted = self.posts[ids]
            there, n = np.unique(text[posted] * FEATURES + ids[posted], return_counts=True)
            text, ids = np.divmod(there, FEATURES)
            many = self.start[ids + 1] - self.start[ids]
            at = np.repeat(self.start[ids] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            cell = np.repeat(text * items, many) + self.posted[at]
            both = np.bincount(cell, weights=np.minimum(self.times[at], np.repeat(n, many)), minlength=len(own) * items)
            enough = both.reshape(len(own), items) >= NEARLY * self.size - 1e-9
            out.append(np.flatnonzero(enough) + low * items)
        return np.concatenate(out)

    def windows(self, i: int, texts: list[np.ndarray]):
        """For each text its windows, one of which holds each run of ``reach`` words that may be a leak of the item."""
        own = np.zeros(FEATURES, dtype=bool)
        own[self.features[i]] = True
        for low, high in _spans([len(x) for x in texts], AT_ONCE):
            upto = np.concatenate([[0], np.cumsum(own[np.concatenate(texts[low:high])])])
            length = np.array([len(x) for x in texts[low:high]])
            begin = np.cumsum(length) - length
            many = -(-length // STEP)
            text = np.repeat(np.arange(high - low), many)
            first = (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)) * STEP
            last = np.minimum(first + self.reach(i) + STEP, length[text])
            kept = np.flatnonzero(upto[begin[text] + last] - upto[begin[text] + first] >= NEARLY * len(self.features[i]) - 1e-9)
            rows = list(zip(first[kept].tolist(), last[kept].tolist(), strict=True))
            ends = np.searchsorted(text[kept], np.arange(high - low + 1)).tolist()
            yield from (rows[x:y] for x, y in zip(ends, ends[1:], strict=False))

    def may_be(self, i: int, window: list[int]) -> bool:
        """Whether the window's features allow for a leak: those it has at all, then in order."""
        own, there = self.features[i], set(window)
        least = NEARLY * len(own) - 1e-9
        return sum(map(there.__contains__, own)) >= least and lcs(own, window) >= least

    def check(self, i: int, window: list[str]) -> tuple[float, float, bool]:
        """Shares of the item and of its answer that the window has in order; whether they make a leak."""
        share = lcs(self.words[i], window) / len(self.words[i])
        answered = lcs(self.answers[i], window) / len(self.answers[i])
        return share, answered, share >= COVERED or share >= NEARLY and answered >= ANSWER


def _similar(parts: list[np.ndarray], space: np.ndarray, items: Items, cosine: float):
    """For windows of ``parts``, the features of some texts, and items that reach ``cosine``: part, item, cosine, first and
    last step of the window, number of its kind."""
    most = max(length for length, _ in WINDOWS)
    n = np.array([-(-len(x) // STEP) for x in parts])
    places = np.maximum(n, most)  # a short text is filled up to the longest window, by feature 0, which adds nothing
    begin = np.cumsum(places) - places
    filled = np.zeros((places.sum(), STEP), dtype=np.uint16)
    flat = filled.ravel()
    for x, at in zip(parts, (begin * STEP).tolist(), strict=True):
        flat[at : at + len(x)] = x
    runs = {1: sum(space[filled[:, i]] for i in range(STEP))}  # sums of 1, 2, 4, ... steps from each place
    while 2 * max(runs) <= most:
        half = max(runs)
        runs[2 * half] = runs[half][:-half] + runs[half][half:]
    for kind, ((length, stride), (own, vectors)) in enumerate(zip(WINDOWS, items.parts, strict=True)):
        end = np.maximum(n - length, 0)
        many = -(-end // stride) + 1
        part = np.repeat(np.arange(len(parts)), many)
        first = np.minimum((np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)) * stride, end[part])
        last = np.minimum(first + length, n[part])
        at, v = begin[part] + first, np.zeros((len(part), space.shape[1]), dtype=np.float32)
        for size in sorted(runs, reverse=True):
            if length & size:
                v += runs[size][at]
                at = at + size
        norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", v, v)), 1e-9)
        for lo in range(0, len(own), ITEMS):
            like = v @ vectors[:, lo : lo + ITEMS]
            w, j = np.divmod(np.flatnonzero(like >= cosine * norm[:, None]), like.shape[1])
            yield part[w], own[lo + j], like[w, j] / norm[w], first[w], last[w], kind


def _parts(ids: list[np.ndarray]):
    """Texts in parts of ``AT_ONCE`` words, with enough of what follows for windows that begin in each: lists of (text,
    first word, features), of about as many words together."""
    reach, held, size = WINDOWS[-1][0] * STEP, [], 0
    for text, own in enumerate(ids):
        for base in range(0, len(own), AT_ONCE):
            held.append((text, base, own[base : base + AT_ONCE + reach]))
            size += max(len(held[-1][2]), reach)  # as which a short one counts in ``_similar``
            if size >= AT_ONCE:
                yield held
                held, size = [], 0
    if held:
        yield held


def all_leaks(texts: list[str], ids: list[np.ndarray], space: np.ndarray, items: Items, cosine: float):
    """For each text (item number, cosine, share, answer's share) of the best window of each item found in it."""
    found: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
    if not items.ids or not texts:
        return [[] for _ in texts]
    words: dict[int, list[str]] = {}  # of the last few texts with a candidate

    def normal_words(text: int, start: int, end: int) -> list[str]:
        if text not in words:
            if len(words) >= 16:
                words.clear()
            words[text] = texts[text].split()
        return [x for word in words[text][start:end] if (x := normal(word))]

    shared = items.shared(ids)
    for parts in _parts(ids):
        text_of, base_of = (np.array(x) for x in list(zip(*parts, strict=True))[:2])
        for part, item, like, first, last, kind in _similar([x for *_, x in parts], space, items, cosine):
            # an item of which the text lacks words cannot be in any of its windows
            cell = text_of[part] * len(items.ids) + item
            may = np.searchsorted(shared, cell, side="right") > np.searchsorted(shared, cell)
            rows = zip(*(x[may].tolist() for x in (text_of[part], base_of[part], item, like, first, last)), strict=True)
            for text, base, i, alike, begin, end in rows:
                more = STEP + max(0, (len(items.words[i]) - WINDOWS[kind][0] * STEP + 1) // 2)
                begin, end = max(base + begin * STEP - more, 0), base + end * STEP + more
                if not items.may_be(i, ids[text][begin:end].tolist()):
                    continue
                share, answered, leak = items.check(i, normal_words(text, begin, end))
                if leak and share > found[text].get(i, (0, 0))[1]:
                    found[text][i] = (alike, share, answered)
    texts_of: dict[int, list[int]] = {}
    for text, i in zip(*(x.tolist() for x in np.divmod(shared, len(items.ids))), strict=True):
        if found[text].get(i, (0, 0))[1] < 1:
            texts_of.setdefault(i, []).append(text)
    windows: dict[int, list] = {}
    for i, own in texts_of.items():
        for text, at in zip(own, items.windows(i, [ids[text] for text in own]), strict=True):
            if at:
                windows.setdefault(text, []).append((i, at))
    for text, of_text in sorted(windows.items()):
        for i, at in of_text:
            for begin, end in at:
                if found[text].get(i, (0, 0))[1] == 1:
                    break
                if not items.may_be(i, ids[text][begin:end].tolist()):
                    continue
                share, answered, leak = items.check(i, normal_words(text, begin, end))
                if leak and share > found[text].get(i, (0, 0))[1]:
                    v = space[ids[text][begin:end]].sum(axis=0)
                    found[text][i] = (float(v @ items.vectors[i] / max(np.linalg.norm(v), 1e-9)), share, answered)
    return [[(i, *x) for i, x in sorted(own.items())] for own in found]


def leaks_of(text: str, ids: np.ndarray, space: np.ndarray, items: Items, cosine: float):
    """The leaks of one text."""
    return all_leaks([text], [ids], space, items, cosine)[0]


LEAKS = "array<struct<item_id: long, cosine: double, covered: double, answered: double>>"


def find_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE) -> DataFrame:
    """row (the columns given), leaks: the benchmark items found in each document, by item.

    ``benchmark`` (item_id, text) is a stated set of queries, of at most ``MAX_ITEMS`` rows (more
    raise an error); all documents are searched against all of it. Null and empty texts, of
    documents or items, match nothing. Rows that repeat are searched each.
    """
    rows = benchmark.select("item_id", "text").where("text is not null").orderBy("item_id", "text").limit(MAX_ITEMS + 1).collect()
    if len(rows) > MAX_ITEMS:
        raise ValueError(f"more than {MAX_ITEMS} benchmark items; search them in parts")
    ids = featured(docs)
    space = fold(ids.select("ids"))
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((space, Items([tuple(r) for r in rows], space)))

    def run(batches):
        space, items = shared.value
        names = ("cosine", "covered", "answered")
        kind = pa.list_(pa.struct([("item_id", pa.int64()), *((c, pa.float64()) for c in names)]))
        for b in batches:
            texts = [t or "" for t in b.column("row").field("text").to_pylist()]
            features = [np.frombuffer(own, dtype=np.uint16) for own in b.column("ids").to_pylist()]
            found = all_leaks(texts, features, space, items, cosine)
            out = [[{"item_id": items.ids[i], **dict(zip(names, x, strict=True))} for i, *x in own] for own in found]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, kind)], ["row", "leaks"])

    return ids.mapInArrow(run, f"row {ids.schema['row'].dataType.simpleString()}, leaks {LEAKS}")


def op8_decontaminate(spark, sf_dir) -> DataFrame:
    found = find_leaks(common.table(spark, sf_dir, "documents").select("doc_id", "text"), common.table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", "leak.item_id", F.round("leak.covered", 4).alias("covered"), F.round("leak.answered", 4).alias("answered")
    )
