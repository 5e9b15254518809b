"""Near-duplicates by ProbMinHash, banding and exact verification.

Weights are how often a shingle of five words occurs. Each shingle is a Poisson process
of that rate; its arrivals fall on components at random, and a component keeps the
earliest. A shingle ends once its next arrival is after the latest kept one, so most are
looked at once or twice. Components of two documents agree with their probability
Jaccard similarity. With all weights 1 they agree with the Jaccard similarity of the sets; texts
have a signature of either kind, the same one where no shingle repeats.

Equal word sequences are one text from the start; only its representative is compared.
In a band's bucket all signatures meet, and what leaves is which of them are connected by pairs that
may be alike: each component's least key with each of its others, so that the many buckets of a group of
near copies name mostly the same pairs. It only says which texts belong together: within each such group
the pairs are then verified on whole texts, so no link depends on which pairs a forest took.

Neither step compares all pairs of a large group (``_met``). Its texts are dealt to blocks, in
several ways, and meet within them; what is found joins them into components. Only texts
outside the largest component of their group are then held against all its blocks: of two
texts still apart, at least one is among these, so none that are alike stay apart. A group of
n near copies costs n comparisons with a block and few more. Components come from hooking
on to smaller ids and pointer jumping.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common, shingles

M, ROWS = 252, 7
SIZE, LEAST = 5, 0.8
#: Share of agreeing components that makes a candidate.
CANDIDATE = 0.72
#: Texts of a block in a band's bucket; texts and characters of a block in a group that is verified.
HOT = 2_000
BLOCK, CHARS = 1_000, 8_000_000
#: Ways in which the texts of a large bucket or group are dealt to blocks.
DEALS = 4
AT_ONCE = 200_000
_U = np.uint64


def _random(x: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Uniforms in (0, 1) and components of the i-th arrivals of shingles."""
    h = shingles._mix(x + _U((i * 0xD1342543DE82EF95) & (2**64 - 1)))
    h ^= h >> _U(32)
    part = shingles._mix(h + _U(0x2545F4914F6CDD1D))
    return ((h >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53, (part >> _U(33)).astype(np.int64) % M


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """n x M shingles that win, for documents 0 to n - 1 with at least one shingle each (others: 0)."""
    kept = np.full(n * M, np.inf)
    winner = np.zeros(n * M, dtype=_U)
    time, rate = np.zeros(len(doc)), weight.astype(np.float64)
    i = 0
    while len(doc):
        i += 1
        u, part = _random(shingle, i)
        time = time - np.log(u) / rate
        at = doc * M + part
        np.minimum.at(kept, at, time)
        won = time == kept[at]
        winner[at[won]] = shingle[won]
        latest = kept.reshape(n, M).max(axis=1)
        on = time < latest[doc]  # early termination
        doc, shingle, rate, time = doc[on], shingle[on], rate[on], time[on]
    return winner.reshape(n, M)


def sketch_texts(texts: list[str], cache: shingles.WordHashes) -> tuple[np.ndarray, list[bytes]]:
    """Signatures (of the set, then of the counted shingles: 2 M), and 128-bit IDs of the word sequences."""
    found, ids, pending, held = [], [], [], 0

    def flush() -> None:
        nonlocal pending, held
        if pending:
            doc = np.repeat(np.arange(len(pending)), [len(s) for s, _ in pending])
            shingle, weight = (np.concatenate(x) for x in zip(*pending, strict=True))
            counted = signatures(doc, shingle, weight, len(pending))
            repeats = np.bincount(doc, weights=weight > 1, minlength=len(pending)) > 0
            own, as_set = repeats[doc], counted.copy()
            number = np.cumsum(repeats) - 1
            as_set[repeats] = signatures(number[doc[own]], shingle[own], np.ones(own.sum()), int(repeats.sum()))
            found.append(np.concatenate([as_set, counted], axis=1))
        pending, held = [], 0

    for text in texts:
        words = text.split()
        ids.append(xxhash.xxh3_128_digest("\0".join(words).encode()))
        s, n = np.unique(shingles.of(shingles.word_hashes(words, cache), SIZE), return_counts=True)
        pending.append((s, n))
        held += len(s)
        if held >= AT_ONCE:
            flush()
    flush()
    return np.concatenate(found) if found else np.zeros((0, 2 * M), dtype=_U), ids


def _sketches(batches):
    cache = shingles.kept_words()
    for b in batches:
        sig, ids = sketch_texts(b.column("text").to_pylist(), cache)
        bands = np.zeros((len(sig), 2 * M // ROWS), dtype=_U)
        for r in range(ROWS):
            bands = shingles._mix(bands + sig[:, r::ROWS])
        bands = shingles._mix(bands + np.tile(np.arange(M // ROWS, dtype=_U), 2)[None])
        bytes_ = shingles._mix(sig).view(np.uint8).reshape(len(sig), 2 * M, 8)[:, :, 7].tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                b.column("id"), b.column("k"), pa.array(ids, pa.binary()),
                pa.array([bytes_[i * 2 * M : (i + 1) * 2 * M] for i in range(len(sig))], pa.binary()),
                pa.array([np.unique(x) for x in bands.view(np.int64)], pa.list_(pa.int64())),
            ],
            ["id", "k", "content", "sig", "bands"],
        )


def spanning(sig: np.ndarray, label: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Pairs of a spanning forest over all pairs that agree in at least ``least`` components of either
    signature. Texts of one label are joined already. Each text that is reached meets all that are not."""
    left, rest, reached, pairs = np.arange(len(sig)), sig, [], []

    def take(own: np.ndarray) -> None:
        nonlocal left, rest
        together = np.isin(label[left], label[left[own]])  # with all that they are joined to
        reached.extend(left[together].tolist())
        left, rest = left[~together], rest[~together]

    while len(left):
        if not reached:  # a new tree
            take(np.arange(1))
            continue
        i = reached.pop()
        near = np.count_nonzero((rest == sig[i]).reshape(len(rest), -1, M), axis=2).max(axis=1) >= least
        if near.any():
            new = left[near]
            _, first = np.unique(label[new], return_index=True)
            pairs += [(i, j) for j in new[first].tolist()]
            take(near)
    return pairs


def _stars(label: tuple[int, ...], pairs: list[tuple[int, int]], out: list[tuple[int, int]]) -> None:
    """Adds to ``out`` what ``pairs`` of places join, as pairs of labels: the least label of each component with each
    of its others. A text is in many buckets: those that see the same component name the same pairs."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while x in up:
            if up[x] in up:
                up[x] = up[up[x]]
            x = up[x]
        return x

    for i, j in pairs:
        a, b = top(label[i]), top(label[j])
        if a != b:
            up[max(a, b)] = min(a, b)
    out.extend((top(x), x) for x in up)


def _cells(columns: list[str], close):
    """Rows sorted by cell (root, x, y) and side: calls ``close`` with the columns of each cell as lists, and yields
    what it appends to its last argument as pairs (a, b)."""

    def run(batches):
        out: list[tuple[int, int]] = []
        cell, held = None, []
        for b in batches:
            for *at, row in zip(
                *(b.column(c).to_pylist() for c in ("root", "x", "y")),
                zip(*(b.column(c).to_pylist() for c in columns), strict=True),
                strict=True,
            ):
                if at != cell:
                    if held:
                        close(*zip(*held, strict=True), out)
                    cell, held = at, []
                held.append(row)
            yield _longs(out, ["a", "b"])
            out.clear()
        if held:
            close(*zip(*held, strict=True), out)
        yield _longs(out, ["a", "b"])

    return run


def _forest(side, k, label, sig, out) -> None:
    sig = np.frombuffer(b"".join(sig), dtype=np.uint8).reshape(len(k), 2 * M)
    _stars(label, spanning(sig, np.unique(label, return_inverse=True)[1], int(CANDIDATE * M)), out)


def _longs(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


def _met(members: DataFrame, payload: DataFrame, ids: DataFrame, compared: str, compare) -> DataFrame:
    """Pairs (a, b), a the least of some that ``compare`` connects and b another one, enough of them to connect all
    that it would find among all pairs of each group. ``members``: root, k, blocks (into which a group of that size is cut); ``payload``: k, ``compared``;
    ``ids``: k, id. ``compare`` takes the columns of a cell sorted by side."""
    spark = members.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ["side", "k", "label", compared]
    found = None

    def of(rows: DataFrame, fewer=lambda pairs: pairs) -> None:
        nonlocal found
        rows = rows.join(payload, "k").repartition(parts, "root", "x", "y").sortWithinPartitions("root", "x", "y", "side", "k")
        pairs = rows.select("root", "x", "y", *columns).mapInArrow(_cells(columns, compare), "a long, b long")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
        new = common.written(fewer(pairs), f"pairs-{compared}")
        found = new if found is None else found.unionByName(new)

    def block(deal) -> Column:
        return F.pmod(F.xxhash64("k", deal), "blocks")

    # within blocks: a group that fits one block is done; others are dealt in several ways
    deal = F.explode(F.sequence(F.lit(0), F.when(F.col("blocks") > 1, DEALS - 1).otherwise(0)))
    of(
        members.select("root", "k", "blocks", deal.alias("deal")).select(
            "root", "k", block(F.col("deal")).alias("x"), F.col("deal").cast("long").alias("y"),
            F.lit(0).alias("side"), F.col("k").alias("label"),
        ),
        _fewer,
    )
    large = members.where("blocks > 1")
    if not large.limit(1).count():
        return found
    # what is outside its group's largest component meets all blocks
    named = large.join(classes(found, ids).select("k", F.col("root").alias("label")), "k", "left")
    named = common.written(named.withColumn("label", F.coalesce("label", "k")), f"named-{compared}")
    sizes = named.groupBy("root", "label").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.groupBy("root").agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("all"))
    # a block for about as many of those apart as a block has texts of the group
    apart_blocks = F.ceil((F.col("all") - F.col("most.n")) * F.col("blocks") / F.col("all")).cast("long")
    split = named.join(most, "root").where(F.col("all") > F.col("most.n"))
    split = split.select("root", "k", "label", "blocks", apart_blocks.alias("others"), (F.col("label") != F.col("most.label")).alias("apart"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = split.select("root", "k", "label", block(F.lit(0)).alias("x"), every("others").alias("y"), F.lit(1).alias("side"))
    far = split.where("apart").select("root", "k", "label", "others", every("blocks").alias("x"))
    far = far.select("root", "k", "label", "x", F.pmod(F.xxhash64("k", F.lit(-1)), "others").alias("y"), F.lit(0).alias("side"))
    of(own.unionByName(far.select(*own.columns)))
    return found


def _fewer(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a the lesser, that connect what ``pairs`` do: each b keeps its least a, and the others it
    has, which near copies have in common, are paired with that one instead. A text has one a for each of its cells
    at most, so no window is large."""
    least = F.min("a").over(Window.partitionBy("b"))
    return pairs.select("a", "b", least.alias("least")).select(
        F.col("least").alias("a"), F.when(F.col("a") > F.col("least"), F.col("a")).otherwise(F.col("b")).alias("b")
    ).distinct()


def candidates(reps: DataFrame) -> DataFrame:
    """a, b: distinct pairs of keys of ``reps`` (k, id, sig, bands) that pairs which may be alike connect, enough of
    them to connect all that share a band and agree in ``CANDIDATE`` of their components."""
    rows = reps.select("k", F.explode("bands").alias("root"))
    counts = rows.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / HOT).cast("long")
    rows = common.written(rows.join(counts, "root").select("root", "k", blocks.alias("blocks")), "buckets")
    return _met(rows, reps.select("k", "sig"), reps.select("k", "id"), "sig", _forest)


def similarity(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> tuple[float, float]:
    """Jaccard similarity of the shingle sets, and probability Jaccard of the weighted ones."""
    if not len(a) and not len(b):
        return 1.0, 1.0
    every = np.union1d(a, b)
    w, v = np.zeros(len(every)), np.zeros(len(every))
    w[np.searchsorted(every, a)] = na
    v[np.searchsorted(every, b)] = nb
    both = (w > 0) & (v > 0)
    with np.errstate(divide="ignore"):
        ratio = v / w
    order = np.argsort(ratio, kind="stable")
    ratio, w, v, both = ratio[order], w[order], v[order], both[order]
    upto = np.searchsorted(ratio, ratio, side="right")
    low, high = np.concatenate([[0], np.cumsum(w)])[upto], v.sum() - np.concatenate([[0], np.cumsum(v)])[upto]
    return both.sum() / len(every), float((1 / (low[both] / w[both] + high[both] / v[both])).sum())


def linked(shingle: list[np.ndarray], count: list[np.ndarray], first: int, least: float):
    """For each text i its links j: to the texts from ``first`` on, if i is before, or with 0 to all after i.

    Sizes of intersections come from postings of shingles. The probability Jaccard similarity is
    at most the overlap of the shingles' shares, so only pairs that reach this are computed."""
    size = np.array([len(s) for s in shingle])
    total = np.array([n.sum() for n in count])
    end = np.cumsum(size)
    at = np.unique(np.concatenate(shingle), return_inverse=True)[1]
    share = np.concatenate(count) / np.repeat(np.maximum(total, 1), size)
    order = np.argsort(at, kind="stable")
    text, its_share = np.repeat(np.arange(len(size)), size)[order], share[order]
    start = np.concatenate([[0], np.cumsum(np.bincount(at))])
    repeats = total > size
    for i in range(first or len(size)):
        own = at[end[i] - size[i] : end[i]]
        n = start[own + 1] - start[own]
        posting = np.repeat(start[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        found = text[posting]
        both = np.bincount(found, minlength=len(size))
        alike = both / np.maximum(size[i] + size - both, 1) >= least
        open_ = ~alike & (repeats | repeats[i])
        open_[: first or i + 1] = alike[: first or i + 1] = False
        if open_.any():
            overlap = np.minimum(np.repeat(share[end[i] - size[i] : end[i]], n), its_share[posting])
            open_ &= np.bincount(found, weights=overlap, minlength=len(size)) >= least - 1e-9
            for j in np.flatnonzero(open_).tolist():
                alike[j] = similarity(shingle[i], count[i], shingle[j], count[j])[1] >= least
        yield i, np.flatnonzero(alike)


def _verified(least: float):
    """Pairs that connect all that are linked in a cell: of its texts among each other, or, where it has two sides,
    of those of side 0 to those of side 1."""

    def close(side, k, label, text, out) -> None:
        first = side.count(0) if side[-1] else 0
        if side[-1] and first in (0, len(k)):  # one side is empty
            return
        cache = shingles.kept_words()
        sets = [np.unique(shingles.of(shingles.word_hashes(t.split(), cache), SIZE), return_counts=True) for t in text]
        joined, pairs = np.unique(label, return_inverse=True)[1], []
        for i, js in linked(*zip(*sets, strict=True), first, least):
            while len(js := js[joined[js] != joined[i]]):
                pairs.append((i, int(js[0])))
                joined[joined == joined[js[0]]] = joined[i]
        _stars(label, pairs, out)

    return close


def links(groups: DataFrame, texts: DataFrame, ids: DataFrame, least: float) -> DataFrame:
    """(a, b): pairs that connect all linked texts (k, text) of each group (k, root), and no others."""
    members = groups.select("k", "root").join(texts.select("k", F.length("text").alias("chars")), "k")
    size = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("chars") / CHARS), F.lit(1)).cast("long")
    members = common.written(members.join(size.select("root", blocks.alias("blocks")), "root").drop("chars"), "members")
    return _met(members, texts, ids, "text", _verified(least))


def classes(links: DataFrame, ids: DataFrame) -> DataFrame:
    """k, root: for each key in ``links`` (a, b) the least (id, k) of its component, as a key.

    ``ids`` (k, id) orders keys. Every round each node takes the least label among its own,
    its neighbours' and that label's label, until nothing changes."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = common.written(both, "edges")
    label = F.struct("id", "k")
    labels = common.written(
        both.select(F.col("a").alias("k")).distinct().join(ids, "k").select(F.col("k").alias("node"), label.alias("label")), "labels"
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").select(F.col("a").alias("node"), "label")
        # hook: my root takes the least label that any of its members sees
        seen = near.unionByName(labels).groupBy("node").agg(F.min("label").alias("label"))
        seen = common.written(seen, "seen")
        hook = (
            labels.select("node", F.col("label.k").alias("root"))
            .join(seen, "node")
            .groupBy("root")
            .agg(F.min("label").alias("hook"))
        )
        new = (
            seen.select("node", "label", F.col("label.k").alias("root"))
            .join(hook, "root", "left")
            .select("node", F.least("label", F.coalesce("hook", "label")).alias("label"))
        )
        new = common.written(new, "labels")
        changed = new.alias("n").join(labels.alias("o"), "node").where("n.label <> o.label").limit(1).count()
        labels = new
        if not changed:
            return labels.select(F.col("node").alias("k"), F.col("label.id").alias("root_id"), F.col("label.k").alias("root"))


def near_duplicates(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """row (the columns given), class_id (least doc_id of the class), root (row key of the one that stays), k,
    n_texts (different texts of the class), stays.

    Two texts are linked if the Jaccard similarity of their sets of five-word shingles, or the
    probability Jaccard similarity of their counted shingles, is at least ``least``; classes are
    the components of links. Texts of one word sequence are one text. Texts under five words
    are one shingle; null and empty ones are alike. One row of each class stays: that of the
    least (doc_id, row key), null ids first; of repeated rows any one.
    """
    keyed = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        F.coalesce("doc_id", F.lit(-(2**63))).alias("id"),
        common.row_key().alias("k"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    schema = "id long, k long, content binary, sig binary, bands array<long>"
    sketches = common.written(keyed.select("id", "k", "text").mapInArrow(_sketches, schema), "sketches")
    reps = sketches.groupBy("content").agg(
        F.min(F.struct("id", "k")).alias("rep"), F.first("sig").alias("sig"), F.first("bands").alias("bands")
    )
    reps = common.written(reps.select("content", "rep.id", "rep.k", "sig", "bands"), "texts")
    ids = reps.select("k", "id")
    groups = classes(candidates(reps.select("k", "id", "sig", "bands")), ids)
    texts = keyed.select("k", "text").join(groups.select("k"), "k").dropDuplicates(["k"])
    roots = classes(links(groups, common.written(texts, "compared"), ids, least), ids)
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("n_texts"))
    roots = roots.join(sizes, "root")
    known = reps.select("content", "id", "k").join(roots, "k", "left").select(
        "content",
        F.coalesce("root", "k").alias("root"),
        F.coalesce("root_id", "id").alias("class_id"),
        F.coalesce("n_texts", F.lit(1)).cast("long").alias("n_texts"),
    )
    placed = sketches.select("k", "content").distinct().join(known, "content").drop("content")
    none = F.when(F.col("class_id") > -(2**63), F.col("class_id"))
    return keyed.select("row", "k").join(placed, "k").select("row", "k", "root", none.alias("class_id"), "n_texts")


def keep_one(found: DataFrame) -> DataFrame:
    """The rows of ``near_duplicates`` that stay: one of each class."""
    return found.where(F.col("k") == F.col("root")).dropDuplicates(["k"])


def op2_prob_minhash(spark, sf_dir) -> DataFrame:
    found = near_duplicates(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "class_id", "n_texts", (F.col("k") == F.col("root")).alias("stays"))
