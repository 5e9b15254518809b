import corpus_pipeline
import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Some documents with planted copies, leaks, toxic ones and nulls, beside benchmark and labels."""
    import random

    rng = random.Random(12)
    words = [f"{a}{b}" for a in ("tha", "er", "ion", "st", "re", "lo") for b in ("an", "ed", "ou", "ly", "th", "n", "s", "tion")]
    text = lambda n: " ".join(rng.choices(words, k=n))
    rows = []
    passage = text(60)
    items = [(i, text(30)) for i in range(5)]
    for i in range(400):
        t = "\n".join(text(rng.randrange(8, 40)) for _ in range(rng.randrange(1, 6)))
        if i % 8 == 0:
            t += " vermin " + text(3) + " scoundrel"
        if i % 50 == 3:
            t += "\n" + passage
        if i % 50 == 5:
            t += " " + items[i % 5][1] + " " + text(10)
        rows.append((i, t, "en", "s", len(t)))
    near = rows[11][1].split(" ")
    near[4] = "edited"
    rows += [(1000, rows[10][1], "en", "s", 1), (1001, " ".join(near), "en", "s", 1), (1002, None, None, None, None), (1003, "", "en", "s", 0)]
    top = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    labels = [(i, 1, int(i % 8 == 0)) for i in range(0, 400) if i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    return top, passage


def test_stages_take_effect(spark, folder):
    top, passage = folder
    docs = spark.read.parquet(f"{top}/documents.parquet")
    before = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, top)
        assert out.columns == before and out.dtypes == docs.dtypes, name
        docs = corpus_pipeline.common.written(out, "test")
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    a, b, c, d = kept.values()
    assert set(range(1004)) >= set(a) and not any(i % 8 == 0 for i in a if i < 400)
    assert len(a) == 400 + 4 - 50
    assert set(b) == set(a)
    assert sum(passage in (t or "") for t in b.values()) == 1
    empty = {i for i, t in b.items() if not t}
    assert b[1000] == "" and {1000, 1002, 1003} <= empty  # a copy loses all its lines
    assert 10 in c and len(empty & set(c)) == 1  # and empty documents are one class
    leaks = {i for i in range(400) if i % 50 == 5}
    assert leaks & set(c) and not leaks & set(d) and len(set(c) - set(d) - leaks) <= 2
    packed = corpus_pipeline.pack(spark, docs, top)
    assert packed.select("doc_id").distinct().count() == len(d)


def test_run_is_its_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder[0])
    assert out.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 2048
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity" and corpus_pipeline.ORACLE_SQL is None


def test_stages_take_odd_documents(spark, folder):
    """No documents, a very long text, repeated rows, null ids, and columns with names that operators use."""
    top, _ = folder
    odd = spark.createDataFrame(
        [(None, "a b"), (7, None), (7, None), (8, "x y z " * 40_000), (9, "x y z " * 40_000)], "doc_id long, text string"
    )
    for name in ("lang", "source", "row", "id", "k", "root", "n", "ids", "gone", "word"):
        odd = odd.withColumn(name, F.lit("v"))
    odd = odd.withColumn("n_chars", F.lit(1).cast("long"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, top)
        assert out.dtypes == odd.dtypes, name
        assert out.count() == (3 if name == "minhash_near_dedup" else 5), name
        assert stage(spark, odd.limit(0), top).collect() == []
    assert corpus_pipeline.pack(spark, odd, top).where("doc_id = 7").count() == 2
    assert corpus_pipeline.pack(spark, odd.limit(0), top).collect() == []
