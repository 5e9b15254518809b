import math
import random

import numpy as np
import pytest
from pyspark.sql.types import ArrayType, FloatType, LongType, StringType, StructField, StructType

from ledgerline.llm import whitening

SCHEMA = StructType(
    [StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType()))]
    + [StructField(c, StringType()) for c in ("label", "x", "n", "block", "component", "d")]
)


def table(spark, pairs, parts=3):
    rows = [(i, v, None, "x", None, "b", "c", None) for i, v in pairs]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), SCHEMA)


def brute_force(pairs, components=4):
    """vec_id -> (deviation, whitened row) by Python integers and a dense covariance; n; shares."""
    kept = [(i, v) for i, v in pairs if v and all(c is not None and math.isfinite(c) for c in v)]
    size = max({len(v) for _, v in kept}, key=lambda d: (sum(len(v) == d for _, v in kept), d))
    kept = [(i, tuple(math.floor(256.0 * float(np.float32(c))) for c in v)) for i, v in kept if len(v) == size]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    m = np.array([[c - s / n for c, s in zip(x, sums, strict=True)] for x in fit])
    values, vectors = np.linalg.eigh(m.T @ m / n)
    top = [i for i in range(size - 1, -1, -1) if values[i] > 1e-12 * values[-1]][:components]
    w = vectors[:, top] / np.sqrt(values[top])
    rows = {}
    for i, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        rows.setdefault(i, []).append((deviation, (np.array([c - s / n for c, s in zip(x, sums, strict=True)]) @ w)))
    return rows, n, values[top] / values.sum()


def check(found, pairs, components=4):
    want, n, shares = brute_force(pairs, components)
    assert len(found) == sum(map(len, want.values())) * len(shares)
    signs = {}
    for r in found:
        c = r["component"] - 1
        own = want[r["vec_id"]]
        assert r["n"] == n and r["deviation"] in [d for d, _ in own]
        z = next(z for d, z in own if d == r["deviation"])
        if abs(z[c]) > 1e-6:
            assert signs.setdefault(c, np.sign(z[c] * r["whitened"])) == np.sign(z[c] * r["whitened"])
        assert abs(abs(r["whitened"]) - abs(z[c])) < 1e-8
        assert r["explained"] == pytest.approx(shares[c], rel=1e-8)
        assert r["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in found}) <= 1


def vectors(seed, n=150, d=6):
    rng = random.Random(seed)
    scale = [3.0, 1.5, 0.8, 0.4, 0.2, 0.1]
    made = [[rng.gauss(5, 1) * scale[j] for j in range(d)] for _ in range(n)]
    made += [made[0]] * 70  # a third of all rows is one vector
    made += [None, [], [1.0] * (d - 1), [float("nan")] + [1.0] * (d - 1), [float("-inf")] + [1.0] * (d - 1), [None] + [0.5] * (d - 1)]
    made += [[-0.0] * d, [0.001] * d, [1e30] + [0.0] * (d - 1)]
    pairs = [(i if i % 50 else None, v) for i, v in enumerate(made)]
    return pairs + [(7, made[7])]


@pytest.mark.parametrize("block_rows", [3, 64, 4096])
def test_whitening_equals_dense_linear_algebra(spark, block_rows):
    pairs = vectors(block_rows)
    found = whitening.whiten(table(spark, pairs), block_rows=block_rows).collect()
    check(found, [p for p in pairs if not p[1] or p[1][0] != 1e30])


def test_few_directions_single_vector_and_empty_table(spark):
    rng = random.Random(2)
    flat = [(i, [a := rng.gauss(0, 9), 2 * a // 1, 0.0, 0.0, 1.0]) for i in range(40)]
    flat = [(i, [v[0], -v[0], 0.0, 0.0, 1.0]) for i, v in flat]
    flat = [(i, [float(round(v[0])), -float(round(v[0])), 0.0, 0.0, 1.0]) for i, v in flat]
    check(whitening.whiten(table(spark, flat)).collect(), flat)  # one direction, one component
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(table(spark, [(1, None)])).collect() == []
    assert whitening.whiten(table(spark, [])).collect() == []


def test_deviations_are_exact_beyond_doubles():
    x = np.array([[10_000_001, -5], [3, 4]], dtype=np.int64)
    assert whitening.deviations(x, 100, [17, -3]) == [sum((100 * c - s) ** 2 for c, s in zip(r, [17, -3], strict=True)) for r in x.tolist()]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    pairs = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(whitening.op11_embedding_whitening(spark, sf).collect(), pairs)
