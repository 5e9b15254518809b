import math
import random

import numpy as np
import pyarrow as pa
from common_cases import documents
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, toxicity


def toxic_cases():
    rng = random.Random(6)
    words = {"en": [f"en{a}{b}" for a in "abcde" for b in "fghij"], "fr": [f"fr{a}{b}" for a in "abcde" for b in "fghij"]}
    bad = {"en": ["scoundrel", "vermin"], "fr": ["crapule", "crapulex", "crapulette"]}
    rows = []
    for i in range(600):
        lang = rng.choice(["en", "fr"])
        text = rng.choices(words[lang], k=rng.randrange(5, 80))
        toxic = i % 6 == 0
        for _ in range(toxic * rng.randrange(1, 4)):
            text.insert(rng.randrange(len(text)), rng.choice(bad[lang]))
        rows.append((i, " ".join(text), lang, int(toxic)))
    return rows


def test_chain_on_held_out_documents(spark):
    rows = toxic_cases()
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows if r[0] % 2] + [(r[0], r[3]) for r in rows[:240]] + [(9999, 1)], "doc_id long, toxic int")
    labels = labels.unionByName(spark.createDataFrame([(3, None)], "doc_id long, toxic int"))
    chain = toxicity.fit(docs, toxicity.categories(docs, labels))
    assert chain.categories[-1] == "toxic" and set(chain.categories[:-1]) == {"toxic_en", "toxic_fr"}
    got = {r["row"]["doc_id"]: r["toxic"] for r in toxicity.classify(docs, chain).collect()}
    held = [r for r in rows if r[0] % 2 == 0 and r[0] >= 240]
    wrong = sum(got[r[0]] != bool(r[3]) for r in held)
    assert sum(r[3] for r in held) > 20 and wrong <= len(held) // 50


def test_chain_takes_odd_inputs(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, "x " * 20_000), (3, "x")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    chain = toxicity.fit(docs, toxicity.categories(docs, none))
    got = toxicity.classify(docs, chain).collect()
    assert len(got) == 4 and not any(r["toxic"] for r in got) and got[0]["row"]["id"] == "y"
    assert toxicity.classify(documents(spark, []), chain).collect() == []


def test_scores_equal_plain_python(spark):
    """Every document's probabilities by loops over words, beginnings and links, without caches or arrays."""
    rows = toxic_cases()[:200]
    docs = documents(spark, [(r[0], r[1]) for r in rows] + [(500, None), (501, ""), (502, "en" * 5000), (3, rows[3][1])])
    labels = spark.createDataFrame([(r[0], r[3], r[0] % 2) for r in rows], "doc_id long, odd int, toxic int")
    chain = toxicity.fit(docs, labels)
    for r in toxicity.classify(docs, chain).collect():
        own = {chain.index[f] for w in (r["row"]["text"] or "").split() for f in toxicity.features(w) if f in chain.index}
        p = []
        for weights in chain.links:
            w = weights.astype(float).tolist()
            z = sum(w[i] for i in own) + sum(a * b for a, b in zip(w[len(chain.index) :], p, strict=False)) + w[-1]
            p.append(1 / (1 + math.exp(-z)))
        assert np.allclose(r["probabilities"], p, atol=1e-4) and r["toxic"] == (r["probabilities"][-1] >= 0.5)


def test_sample_is_that_of_the_least_hashes(spark):
    from ledgerline.llm import common

    df = spark.range(0, 50_000, 1, 40).select("id", F.xxhash64("id").alias("h"))
    want = [r["id"] for r in df.orderBy("h").limit(300).collect()]
    got = common.least_hashes(df, df.count(), F.col("h"), 300)
    assert [r["id"] for r in got.orderBy("h").collect()] == want
    assert common.least_hashes(df.limit(5), 5, F.col("h"), 300).count() == 5


def test_later_links_use_earlier_probabilities():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (400, 6)).astype(np.float32)
    y = np.stack([x[:, 0], x[:, 0]], axis=1)
    links = toxicity.fit_chain(x, y, np.arange(400) % 4)
    assert [len(w) for w in links] == [7, 8]
    assert links[1][6] > 0


def lcs(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


def test_lcs_equals_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        a, b = (rng.choices("abcd", k=rng.randrange(1, 20)) for _ in range(2))
        assert decontaminate.lcs(a, b) == lcs(a, b)


def leak_cases():
    rng = random.Random(8)
    words = [f"{a}{b}{c}" for a in "klmnp" for b in "aeiou" for c in ("r", "s", "t", "nd", "lk", "m", "")]
    usual = rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=40_000)
    text = lambda n: " ".join(usual[(a := rng.randrange(39_000)) : a + n])
    items = [(i, f"{' '.join(rng.choices(words, k=rng.randrange(14, 60)))}. {' '.join(rng.choices(words, k=6))}.") for i in range(20)]
    docs, want = [], set()
    for i in range(300):
        t = text(rng.randrange(20, 500))
        if i % 10 == 0:
            k = rng.randrange(20)
            leak = items[k][1].split()
            if i % 20 == 0:  # a paraphrase: some words replaced
                for p in rng.sample(range(len(leak)), len(leak) // 10):
                    leak[p] = "changed"
            t = f"{t} {' '.join(leak)} {text(30)}"
            want.add((i, k))
        docs.append((i, t))
    return docs, items, want


def test_leaks_and_paraphrases_are_found(spark):
    docs, items, want = leak_cases()
    benchmark = spark.createDataFrame([*items, (90, None), (91, ""), (92, "...")], "item_id long, text string")
    rows = [*docs, (900, None), (901, ""), (902, "one"), (902, "one")]
    found = decontaminate.find_leaks(documents(spark, rows), benchmark).collect()
    got = {(r["row"]["doc_id"], x["item_id"]) for r in found for x in r["leaks"]}
    assert len(found) == len(rows) and found[0]["row"]["id"] == "y"
    assert len(want - got) <= 1 and len(got - want) <= 1
    assert decontaminate.find_leaks(documents(spark, []), benchmark).collect() == []
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(documents(spark, rows[:5]), empty).select(F.size("leaks")).distinct().collect() == [(0,)]


def test_leaks_of_any_length_equal_brute_force():
    """Items of 5 to 400 words, 0.6 to 1.0 of them copied, against the check of every window."""
    rng = random.Random(9)
    words = [f"{a}{b}{c}{d}" for a in "klmnp" for b in "aeiou" for c in "rstmn" for d in "aeiou"]
    rows = [(n, " ".join(rng.choices(words, k=n))) for n in (5, 12, 30, 60, 91, 145, 200, 300, 400)]
    space = np.random.default_rng(3).normal(size=(decontaminate.FEATURES, 56)).astype(np.float32)
    space[0] = 0
    items, features = decontaminate.Items(rows, space), decontaminate.Features()
    recall = 0
    for i, (n, text) in enumerate(rows):
        for kept in (1.0, 0.9, 0.8, 0.75, 0.7, 0.65, 0.6):
            item = text.split()
            body = n - len(items.answers[i])
            for p in rng.sample(range(body), min(n - math.ceil(kept * n - 1e-9), body)):
                item[p] = "changed"
            doc = [*rng.choices(words, k=rng.randrange(90)), *item, *rng.choices(words, k=rng.randrange(90))]
            want = set()
            for j in range(len(rows)):
                length = max(len(items.words[j]), 4 * decontaminate.STEP)
                if any(items.check(j, doc[a : a + length])[2] for a in range(max(len(doc) - length, 0) + 1)):
                    want.add(j)
            got = {x[0] for x in decontaminate.leaks_of(" ".join(doc), features.of(doc), space, items, decontaminate.COSINE)}
            assert i in want and want <= got
            recall += len(want)
    assert recall >= 63


def test_only_items_whose_words_a_text_has_are_checked(monkeypatch):
    """Texts searched together give what each gives alone, over several parts too; a likeness without shared words
    costs no check."""
    rng = random.Random(10)
    words = [f"{a}{b}{c}" for a in "klmnprst" for b in "aeiou" for c in "rstmn"]
    items_text = [(n, " ".join(rng.choices(words, k=n))) for n in (12, 30, 45)]
    docs = [" ".join(rng.choices([f"{w}x" for w in words], k=rng.randrange(1, 90))) for _ in range(40)] + ["", "."]
    docs[7] += " " + items_text[1][1]
    docs[9] = " ".join([docs[3]] * 12 + [items_text[2][1], docs[4]])
    space = np.ones((decontaminate.FEATURES, 56), dtype=np.float32)  # all are alike
    space[0] = 0
    items, features = decontaminate.Items(items_text, space), decontaminate.Features()
    ids = [features.of(t.split()) for t in docs]
    monkeypatch.setattr(decontaminate, "AT_ONCE", 320)
    alone = [decontaminate.leaks_of(t, f, space, items, 0.6) for t, f in zip(docs, ids, strict=True)]
    calls = []
    real = decontaminate.Items.may_be
    monkeypatch.setattr(decontaminate.Items, "may_be", lambda self, i, window: calls.append(i) or real(self, i, window))
    together = decontaminate.all_leaks(docs, ids, space, items, 0.6)
    assert [[x[0] for x in own] for own in together] == [[x[0] for x in own] for own in alone]
    assert {n: [x[0] for x in own] for n, own in enumerate(together) if own} == {7: [1], 9: [2]}
    assert not {0} & set(calls)


def test_words_and_windows_of_a_batch(monkeypatch):
    """All spellings of a word are one entry; the windows of an item in many texts are those in each."""
    features = decontaminate.Features()
    monkeypatch.setattr(decontaminate, "_kept_features", lambda: features)
    texts = ["Word WORD word", "(\u00c9t\u00e9) \u039f\u03a3A\u03a3 \u212a", ""]
    (got,) = decontaminate._ids([pa.RecordBatch.from_pylist([{"row": {"doc_id": 1}, "text": t} for t in texts])])
    assert len(features) == 4
    want = [decontaminate.Features().of(t.split()).tobytes() for t in texts]
    assert got.column("ids").to_pylist() == want
    rng = random.Random(11)
    words = [f"{a}{b}" for a in "klmnprst" for b in "aeiou"]
    item = rng.choices(words, k=12)
    items = decontaminate.Items([(1, " ".join(item))], np.ones((decontaminate.FEATURES, 56), dtype=np.float32))
    ids = [features.of(rng.choices(words, k=rng.randrange(0, 200)) + item) for _ in range(30)]
    monkeypatch.setattr(decontaminate, "AT_ONCE", 320)
    own, reach = set(items.features[0]), items.reach(0) + decontaminate.STEP
    for text, windows in zip(ids, items.windows(0, ids), strict=True):
        every = [(x, min(x + reach, len(text))) for x in range(0, len(text), decontaminate.STEP)]
        assert windows == [(x, y) for x, y in every if sum(f in own for f in text[x:y].tolist()) >= decontaminate.NEARLY * 12 - 1e-9]


def test_fold_is_the_svd(spark):
    """Latent vectors of passages agree with a dense SVD of the same matrix, up to rotation in sign."""
    docs, _, _ = leak_cases()
    table = spark.createDataFrame([(i, " ".join(t.split()[:32])) for i, t in docs], "doc_id long, text string")
    space = decontaminate.fold(decontaminate.featured(table).select("ids"), rank=40, iterations=4)
    features = decontaminate.Features()
    rows = [features.of(t.split()[:32]) for _, t in docs]
    n = np.zeros(decontaminate.FEATURES)
    for r in rows:
        n[np.unique(r)] += 1
    idf = np.where(n > 0, np.log((len(rows) + 1) / np.maximum(n, 1)) + 0.1, 0)
    idf[0] = 0
    a = np.zeros((len(rows), decontaminate.FEATURES))
    for i, r in enumerate(rows):
        np.add.at(a[i], r, idf[r])
        a[i] /= np.sqrt((idf[r] ** 2).sum())
    values = np.linalg.svd(a[:, n > 0], compute_uv=False)
    back = space / np.where(idf > 0, idf, 1)[:, None]  # singular vectors over their values
    norms = np.sort(1 / np.linalg.norm(back, axis=0))[::-1]
    near = values[decontaminate.COMMON : decontaminate.COMMON + 8]
    assert np.allclose(norms[:8], near, rtol=0.1)
