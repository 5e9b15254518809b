import random
from collections import defaultdict

import duckdb
import numpy as np
from common_cases import documents

from ledgerline.llm import line_dedup, prob_minhash


def brute_lines(pairs, least):
    seen, out = set(), {}
    order = sorted(set(pairs), key=lambda p: p[0])
    for i, s in order:
        lines = (s or "").split("\n")
        gone = set()
        for a in range(len(lines)):
            words = 0
            for e in range(a, len(lines)):
                words += len(lines[e].split())
                if words >= least:
                    run = tuple(lines[a : e + 1])
                    if run in seen:
                        gone |= set(range(a, e + 1))
                    seen.add(run)
                    break
        out[i] = "\n".join(x for n, x in enumerate(lines) if n not in gone), len(lines), len(gone)
    return out


def line_cases():
    rng = random.Random(2)
    lines = [" ".join(rng.choices("abcdefgh", k=rng.randrange(6))) for _ in range(12)]
    pairs = [(i, "\n".join(rng.choices(lines, k=rng.randrange(1, 25)))) for i in range(70)]
    return [*pairs, (80, None), (81, ""), (82, "a\n" * 300), (83, pairs[5][1]), (84, "\n".join(lines * 3))]


def test_line_runs_equal_brute_force(spark):
    for least in (1, 7, 30):
        got = line_dedup.dedup(documents(spark, line_cases()), least).collect()
        have = {r["row"]["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in got}
        assert have == brute_lines(line_cases(), least)
        assert all(sum(x["lines"] for x in r["runs"]) == r["n_removed"] for r in got)
        assert got[0]["row"]["id"] == "y"


def test_line_sql_equals_brute_force():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, s) for i, s in line_cases() if i != 82])
    got = con.execute(line_dedup.op3_sql(7)).fetchall()
    want = brute_lines([p for p in line_cases() if p[0] != 82], 7)
    assert {r[0]: r[2] for r in got} == {i: x[2] for i, x in want.items()}


def test_repeated_rows_and_empty_table(spark):
    long = "\n".join("abcde fg hi" for _ in range(20)) + "\nlast of it all here"
    got = line_dedup.dedup(documents(spark, [(1, long), (1, long), (2, long)]), 5).collect()
    # of the run of 20 equal lines the first two, the shortest run of five words, stay; the copy goes whole
    have = sorted((r["row"]["doc_id"], r["n_removed"]) for r in got)
    want = brute_lines([(1, long), (2, long)], 5)
    assert have == [(1, want[1][2]), (1, want[1][2]), (2, want[2][2])] and want[2][2] == 21
    assert line_dedup.dedup(documents(spark, [])).collect() == []


def shingle_set(s):
    w = (s or "").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def brute_classes(pairs, least=0.8):
    sets = [shingle_set(s) for _, s in pairs]
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(pairs)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if (not x and not y) or (x | y and len(x & y) / len(x | y) >= least):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for n in range(len(pairs)):
        groups[find(n)].append(pairs[n][0])
    return sorted(sorted(g) for g in groups.values())


def near_cases():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    pairs, n = [], 0
    for size in (1, 1, 2, 5, 40):
        base = rng.choices(words, k=200)
        for _ in range(size):
            changed = list(base)
            for p in rng.sample(range(200), rng.choice([0, 1, 1, 2, 3])):
                changed[p] = rng.choice(words)
            pairs.append((n, " ".join(changed)))
            n += 1
    return [*pairs, (200, None), (201, ""), (202, " \n "), (203, "one two"), (204, "one  two"), (205, "one three")]


def test_classes_equal_brute_force(spark):
    got = prob_minhash.near_duplicates(documents(spark, near_cases())).collect()
    groups = defaultdict(list)
    for r in got:
        groups[r["class_id"]].append(r["row"]["doc_id"])
    assert sorted(sorted(g) for g in groups.values()) == brute_classes(near_cases())
    assert all(k == min(g) for k, g in groups.items())


def test_hot_buckets_in_parts(spark, monkeypatch):
    monkeypatch.setattr(prob_minhash, "HOT", 10)
    kept = prob_minhash.keep_one(prob_minhash.near_duplicates(documents(spark, near_cases())))
    assert sorted(r["row"]["doc_id"] for r in kept.collect()) == [g[0] for g in brute_classes(near_cases())]


def test_repeated_rows_keep_one(spark):
    kept = prob_minhash.keep_one(prob_minhash.near_duplicates(documents(spark, [(1, "a b c"), (1, "a b c"), (2, "a b c")])))
    assert kept.count() == 1
    assert prob_minhash.near_duplicates(documents(spark, [])).collect() == []


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 300).astype(np.uint64)
    b = np.concatenate([a[:240], rng.integers(0, 2**63, 60).astype(np.uint64)])
    wa, wb = rng.integers(1, 6, 300), rng.integers(1, 6, 300)
    sig = [
        prob_minhash.signatures(np.repeat([0, 1], 300), np.concatenate([a + np.uint64(i), b + np.uint64(i)]), np.concatenate([wa, wb]), 2)
        for i in range(20)
    ]
    estimate = np.mean([(s[0] == s[1]).mean() for s in sig])
    order_a, order_b = np.argsort(a), np.argsort(b)
    exact = prob_minhash.similarity(a[order_a], wa[order_a], b[order_b], wb[order_b])[1]
    w, v = defaultdict(float, zip(a.tolist(), wa.tolist())), defaultdict(float, zip(b.tolist(), wb.tolist()))
    every = set(w) | set(v)
    brute = sum(1 / sum(max(w[e] / w[d], v[e] / v[d]) for e in every) for d in every if w[d] and v[d])
    assert abs(exact - brute) < 1e-9
    assert abs(estimate - exact) < 0.03


def edited(base, places, n):
    out = list(base)
    for p in places:
        out[p] = f"edit{n}at{p}"
    return " ".join(out)


def found_classes(found):
    groups = defaultdict(list)
    for r in found.collect():
        groups[r["class_id"]].append(r["row"]["doc_id"])
    return sorted(sorted(g) for g in groups.values())


def test_classes_do_not_depend_on_blocks(spark, monkeypatch):
    whole = sorted(map(tuple, prob_minhash.near_duplicates(documents(spark, near_cases())).select("k", "root", "n_texts").collect()))
    for hot, block in ((10, 10), (2000, 4)):
        monkeypatch.setattr(prob_minhash, "HOT", hot)
        monkeypatch.setattr(prob_minhash, "BLOCK", block)
        again = prob_minhash.near_duplicates(documents(spark, near_cases())).select("k", "root", "n_texts")
        assert sorted(map(tuple, again.collect())) == whole


def test_two_classes_in_one_large_group(spark, monkeypatch):
    """Two sets of near copies share bands with each other without a link: what is outside the larger one meets
    all its blocks, and single texts that link only to few members are found."""
    rng = random.Random(21)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    far = edited(base, range(0, 200, 22), "far").split()  # 10 places: a similarity of about 0.63 to the base
    pairs = [(n, edited(base, rng.sample(range(200), 1), n)) for n in range(45)]
    pairs += [(100 + n, edited(far, rng.sample(range(200), 1), n)) for n in range(30)]
    pairs += [(200 + n, edited(base, range(5 + n, 200, 40), f"e{n}")) for n in range(4)]
    monkeypatch.setattr(prob_minhash, "HOT", 8)
    monkeypatch.setattr(prob_minhash, "BLOCK", 8)
    assert found_classes(prob_minhash.near_duplicates(documents(spark, pairs))) == brute_classes(pairs)


def test_near_copies_cost_in_proportion(spark, monkeypatch):
    """Rows that meet in cells: twice the near copies, about twice the rows."""
    rng = random.Random(22)
    base = [f"w{rng.randrange(3000)}" for _ in range(60)]
    monkeypatch.setattr(prob_minhash, "HOT", 20)
    monkeypatch.setattr(prob_minhash, "BLOCK", 20)
    rows = []
    real = prob_minhash._cells

    def counted(columns, close):
        run = real(columns, close)
        n = spark.sparkContext.accumulator(0)
        rows[-1].append(n)

        def counting(batches):
            def each():
                for b in batches:
                    n.add(len(b))
                    yield b

            return run(each())

        return counting

    monkeypatch.setattr(prob_minhash, "_cells", counted)
    for size in (150, 300):
        rows.append([])
        pairs = [(n, edited(base, [rng.randrange(60)], n)) for n in range(size)]
        found = prob_minhash.near_duplicates(documents(spark, pairs))
        assert found.where("class_id = 0").count() > 0.9 * size
    small, large = (sum(n.value for n in x) for x in rows)
    assert large < 3 * small


def test_buckets_of_near_copies_name_the_same_pairs(spark, monkeypatch):
    """The pairs that components are made of: a few for each near copy, not one for each of its buckets and deals."""
    rng = random.Random(23)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    pairs = [(n, edited(base, rng.sample(range(120), 2), n)) for n in range(240)]
    monkeypatch.setattr(prob_minhash, "HOT", 60)
    monkeypatch.setattr(prob_minhash, "BLOCK", 60)
    rows = []
    real = prob_minhash.classes
    monkeypatch.setattr(prob_minhash, "classes", lambda links, ids: rows.append(links.count()) or real(links, ids))
    assert found_classes(prob_minhash.near_duplicates(documents(spark, pairs))) == brute_classes(pairs)
    assert max(rows) < 3 * len(pairs)


def test_stars_join_labels():
    out = []
    prob_minhash._stars((5, 5, 9, 2, 7, 8), [(0, 2), (3, 2), (4, 5)], out)
    assert sorted(out) == [(2, 5), (2, 9), (7, 8)]


def test_chained_edits_over_blocks(spark, monkeypatch):
    """Chains in which only texts a few edits apart are alike, many of them in one bucket, cut into blocks."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    pairs = []
    for chain in range(8):
        places = rng.sample(range(0, 200, 5), 20)
        pairs += [(100 * chain + n, edited(base, places[:n], chain)) for n in range(21)]
    monkeypatch.setattr(prob_minhash, "HOT", 10)
    monkeypatch.setattr(prob_minhash, "BLOCK", 10)
    assert found_classes(prob_minhash.near_duplicates(documents(spark, pairs))) == brute_classes(pairs)


def test_templates_over_blocks(spark, monkeypatch):
    """Texts of one template that share bands but are none of them near to all: the same as in one block."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    pairs = [(n, edited(base, rng.sample(range(0, 200, 5), 2), n)) for n in range(60)]
    monkeypatch.setattr(prob_minhash, "HOT", 10)
    monkeypatch.setattr(prob_minhash, "BLOCK", 10)
    assert found_classes(prob_minhash.near_duplicates(documents(spark, pairs))) == brute_classes(pairs) == [list(range(60))]


def test_alike_as_sets_with_other_counts(spark):
    """A text, and the same with a line repeated many times: alike as sets, not as counted shingles."""
    rng = random.Random(13)
    pairs = []
    for n in range(20):
        base = " ".join(f"w{rng.randrange(3000)}" for _ in range(200))
        line = " ".join(f"x{rng.randrange(3000)}" for _ in range(10))
        pairs += [(2 * n, base), (2 * n + 1, f"{base} {' '.join([line] * 50)}")]
    got = prob_minhash.near_duplicates(documents(spark, pairs)).collect()
    assert {r["row"]["doc_id"]: r["class_id"] for r in got} == {i: i // 2 * 2 for i, _ in pairs}
