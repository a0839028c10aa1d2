"""Near vectors, the Jaccard join and components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from worklink.llm import common, embeddings, jaccard
from worklink.llm.components import connected_components, spanning


def brute_components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "empty"])
def test_components(spark, shape):
    rng = random.Random(3)
    edges = {"chain": [(i, i + 1) for i in range(40)], "star": [(i, 100) for i in range(60)],
             "random": [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(90)], "empty": []}[shape]
    edges = edges + edges[:3] + ([(7, 7)] if edges else [])
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    real = [e for e in edges if e[0] != e[1]]
    nodes = {n for e in real for n in e}
    assert {r.node: r.component for r in found.collect()} == brute_components(nodes, real)


def test_spanning_joins_the_same_nodes():
    rng = random.Random(5)
    pairs = [(rng.randint(0, 30), rng.randint(0, 30)) for _ in range(200)]
    kept = list(spanning(*zip(*pairs)))
    nodes = {n for p in pairs for n in p}
    assert brute_components(nodes, kept) == brute_components(nodes, pairs) and len(kept) < len(nodes)


# ------------------------------------------------------------------ vectors


def near_groups(rng, n=150, dim=16):
    base = rng.standard_normal((n // 5, dim))
    x = [b + 0.12 * rng.standard_normal(dim) * rng.random() for b in base for _ in range(5)]
    return [v.tolist() for v in x]


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 4)  # buckets of many blocks
    rng = np.random.default_rng(1)
    values = near_groups(rng)
    values += [values[0]] * 40 + [[2 * v for v in values[0]]] + [[0.0] * 16, None, [], [1.0, float("nan")] * 8, [None] + [1.0] * 15]
    values += [[1.0, 2.0], [1.0, 2.1], [1e-300] * 16, [1e300] * 16, [-v for v in values[0]]]
    rows = [(3 * i, v, "x", 5) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, codes string, n_links int")
    found = {r.vec_id: r for r in embeddings.near_vectors(df, planes=4).collect()}
    assert len(found) == len(rows)
    links = {k: 0 for k in found}
    pairs = []
    for i, (a, va, *_) in enumerate(rows):
        for b, vb, *_ in rows[:i]:
            if not va or not vb or len(va) != len(vb) or None in va or None in vb:
                continue
            x, y = np.array(va) / max(map(abs, va) or [1]) if any(va) else np.zeros(len(va)), np.array(vb) / max(map(abs, vb)) if any(vb) else np.zeros(len(vb))
            norm = np.sqrt((x @ x) * (y @ y))
            if norm and np.isfinite(norm) and x @ y / norm >= 0.95:
                links[a] += 1
                links[b] += 1
                pairs.append((a, b))
    assert {k: r.n_links for k, r in found.items()} == links
    component = brute_components(links, pairs)
    assert {k: r.component_id for k, r in found.items()} == component
    assert all(r.kept == (component[k] == k) for k, r in found.items())


def test_vectors_recall_at_the_threshold(spark):
    """Pairs at a cosine of just 0.95 are found but for the stated chance."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        x = rng.standard_normal(64)
        x /= np.linalg.norm(x)
        y = rng.standard_normal(64)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        rows += [(2 * i, x.tolist()), (2 * i + 1, (0.9501 * x + np.sqrt(1 - 0.9501 ** 2) * y).tolist())]
    found = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sum(r.n_links == 1 for r in found) >= 0.99 * len(found)


def test_vectors_odd_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.near_vectors(empty).collect() == []
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (None, [1.0, 0.0])]
    found = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id) for r in found if r.vec_id) == [(1, 0, 1), (1, 0, 1), (2, 0, 2)]
    assert [r.component_id for r in found if r.vec_id is None] == [None]


# ------------------------------------------------------------------ shingle sets


def shingle_set(text, words):
    found = (text or "").encode().lower().split()
    if not found:
        return set()
    return {tuple(found[i:i + words]) for i in range(max(1, len(found) - words + 1))}


def brute_jaccard(rows, words, percent):
    sets = {k: shingle_set(t, words) for k, t in rows}
    ids = sorted(sets)
    links = []
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common, total = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if total and 100 * common >= percent * total:
                links.append((a, b))
    return sets, brute_components(ids, links)


def edited_texts(rng, n, sizes, share):
    """Texts and copies of them with some words changed."""
    out = []
    for _ in range(n):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice(sizes))]
        out.append(base)
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, int(share * len(base))))):
                copy[rng.randrange(len(copy))] = f"w{rng.randint(0, 400)}"
            out.append(copy[rng.randint(0, 1):])
    return [" ".join(words) for words in out]


@pytest.mark.parametrize("words, percent, sizes", [
    (3, 90, [4, 12, 15, 21, 24, 35]), (5, 80, [6, 9, 11, 14, 20]), (3, 90, [60, 200, 500]), (5, 80, [60, 150])])
def test_jaccard_against_brute_force(spark, words, percent, sizes):
    rng = random.Random(words * percent + sizes[0])
    texts = edited_texts(rng, 60, sizes, 0.04)
    texts += [texts[0]] * 30 + [None, "", " \t\n", "One", "one", "TWO words", "two\x0bWORDS", "two\xa0words", "É a b c", "é a b c"]
    rows = [(7 * i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, component_id string, n int")
    sets, component = brute_jaccard(rows, words, percent)
    found = jaccard.jaccard_components(docs, words, percent).collect()
    assert {r.doc_id: r.n_shingles for r in found} == {k: len(s) for k, s in sets.items()}
    assert {r.doc_id: r.component_id for r in found} == component


def variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.choice(edits)):
            words[at] = rng.choice(["new", f"w{rng.randint(0, 40)}"])
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_lists_of_several_components(spark, seed):
    """Around one text lie many that link with some of each other only: their differences have to find the rest."""
    rng = random.Random(seed)
    texts = variants(rng, [f"s{i}" for i in range(60)], 150, [1, 2, 3, 4])
    shared = [f"p{i}" for i in range(60)]
    texts += [" ".join(shared + [f"x{rng.randint(0, 3)}_{j}" for j in range(rng.choice([6, 9, 12]))]) for _ in range(60)]
    rows = list(enumerate(texts))
    sets, component = brute_jaccard(rows, 3, 90)
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert {r.doc_id: r.component_id for r in found} == component
    assert 1 < len(set(component.values())) < len(rows)


@pytest.mark.parametrize("percent", [70, 80, 90, 95])
def test_linked_sets_share_a_list(percent):
    """The boundary and the levels lose no linked pair, at any boundary."""
    rng = np.random.default_rng(percent)
    for small in (0, 8, 14):
        shingler = jaccard.Shingler(3, percent, small)
        for _ in range(150):
            n = int(rng.integers(1, 120)) if rng.random() < 0.5 or not small else int(rng.integers(1, small + 3))
            a = np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64))
            b = a.copy()
            for _ in range(200):  # as different as a link allows
                c = np.unique(np.r_[rng.permutation(b)[:len(b) - int(rng.integers(0, 2))], rng.integers(0, 2 ** 63, int(rng.integers(0, 2)), dtype=np.uint64)])
                common = len(np.intersect1d(a, c))
                if 100 * common < percent * (len(a) + len(c) - common):
                    break
                b = c
            if (a.shape == b.shape) and (a == b).all():
                continue
            ka, _, levels, least = shingler.entries(a)
            kb = set(shingler.entries(b)[0].tolist())
            met = [(i, n) for k, i, n in zip(ka.tolist(), levels.tolist(), least.tolist()) if k in kb]
            assert met, (len(a), len(b), small)
            # at one level they share as many lists as the entries say
            assert any(sum(j == i for j, _ in met) >= n for i, n in met), (len(a), len(b), small)


def test_jaccard_odd_tables(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (5, "g"), (None, "a b c d e f"), (9, "a b c d e f"), (2, None)]
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in found) == [(-1, -1), (2, 2), (5, 5), (5, 5), (5, 5), (9, 5)]
    kept = jaccard.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in kept) == [(-1, "a b c d e f"), (2, ""), (5, "a b c d e f")]


def test_jaccard_boundary_follows_the_cost():
    assert jaccard.boundary({}, 90) == 0
    assert jaccard.boundary({12: 1000}, 90) >= 12
    assert jaccard.boundary({32: 1000}, 80) < 32
    assert jaccard.overlap(10, 9, 90) == 9 and jaccard.overlap(10, 10, 90) == 10


def test_stored_tables_leave_no_shuffle_files(spark):
    def blocks():
        on_disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {b for b in on_disk.mkString(" ").split() if b.startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(key), blocks()
    counts = common.stored(spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert not blocks() - before and spark.conf.get(key) == setting
    assert {r.k: r["count"] for r in counts.collect()} == {k: 1429 if k < 4 else 1428 for k in range(7)}
