"""Exact duplicates, periodic runs and source divergence against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from worklink.llm import divergence, exact, runs

BLANK = re.compile(r"[\x20\x09-\x0D]+")


# ------------------------------------------------------------------ exact duplicates


def copies(seed, n=300):
    rng = random.Random(seed)
    base = ["", " ", "same", "samf", "same text\twith  blanks", "x" * 70 + "a", "x" * 70 + "b", "é\x1c\x85\xa0", "long " * 30_000]
    rows = [(i, rng.choice(base).replace(" ", rng.choice([" ", "\n", "\t \r"]))) for i in rng.sample(range(10 * n), n)]
    return rows + [(10 * n + 1, None), rows[0], (None, rows[1][1]), (None, "only here"), (None, "only here"), (7, "alone")]


def brute_groups(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[BLANK.sub(" ", text or "")].append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def documents(spark, rows):
    """The rows with extra columns whose names clash with those the operators use."""
    return spark.createDataFrame([(i, t, 1, "z", None) for i, t in rows],
                                 "doc_id long, text string, length int, digest string, keep_id string")


@pytest.mark.parametrize("weak", [False, True])
def test_exact_duplicates_against_brute_force(spark, weak):
    """The content decides, also under hashes that throw different texts together."""
    rows = copies(1)
    hashes = {"prefix_hash": lambda t: F.length(t) % 2, "full_hash": lambda t: (F.length(t) % 3).cast("string")} if weak else {}
    got = [tuple(r) for r in exact.exact_duplicates(documents(spark, rows), digests=True, **hashes).collect()]
    want = brute_groups(rows)
    assert sorted((r[:4] if weak else r for r in got), key=str) == sorted((r[:4] if weak else r for r in want), key=str)


def test_exact_digests_only_where_needed(spark):
    got = {r.doc_id: r.digest for r in exact.exact_duplicates(documents(spark, [(1, "a b"), (2, "a\tb"), (3, "c")])).collect()}
    assert got[1] == got[2] == hashlib.sha256(b"a b").hexdigest() and got[3] is None


def test_exact_empty_table_and_one_group(spark):
    assert exact.exact_duplicates(documents(spark, []).limit(0)).collect() == []
    rows = exact.exact_duplicates(documents(spark, [(i, "all alike") for i in range(5000)])).collect()
    assert {(r.keep_id, r.group_size) for r in rows} == {(0, 5000)} and [r.doc_id for r in rows if r.kept] == [0]


def test_exact_main_path_has_no_python(spark):
    plan = exact.exact_duplicates(documents(spark, copies(2)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------ periodic runs


def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - s + q >= max(6, 4 * q):
                found.setdefault((s, i - s + q), q)
            i += i == s
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_words(rng):
    letters, words = rng.choice([1, 2, 3, 20]), []
    for _ in range(rng.randint(0, 12)):
        unit = [rng.randint(0, letters) for _ in range(rng.randint(1, 7))]
        words += (unit * 8)[: rng.randint(1, 8 * len(unit))]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(150):
        texts = [periodic_words(rng) for _ in range(rng.randint(0, 6))]
        starts = np.cumsum([0] + [len(t) for t in texts])
        got = list(zip(*(x.tolist() for x in runs.find_runs(np.array(sum(texts, []), np.int64), starts))))
        want = [(s + int(o), n, q) for t, o in zip(texts, starts) for s, n, q in brute_runs(t)]
        assert got == want, texts


def test_runs_of_long_texts():
    for words, want in (([0] * 200_000, (0, 200_000, 1)), ([i % 9 for i in range(100_000)], (0, 100_000, 9))):
        got = runs.find_runs(np.array(words, np.int64), np.array([0, len(words)]))
        assert [tuple(x) for x in zip(*got)] == [want]
    many = [w for i in range(20_000) for w in [i + 10] + [0] * 6]
    assert len(runs.find_runs(np.array(many, np.int64), np.array([0, len(many)]))[0]) == 20_000


def plant(doc_id, text):
    words = BLANK.split((text or "").strip(" \t\n\v\f\r")) if (text or "").strip(" \t\n\v\f\r") else []
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_run_digests_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(runs, "SLICE_WORDS", 50)
    rng = random.Random(9)
    rows = [(i, rng.choice(["\n", " ", " \t"]).join(map(str, periodic_words(rng)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, " \n"), (None, "a a a a a a a"), rows[5], (303, "é\x1c " * 9), (304, " lead and trail ")]
    rows += [(i, "some words that get a period " * 3) for i in range(400, 460)]
    want = []
    for i, text in rows:
        words = plant(i, text)
        found = brute_runs(words)
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (
            "".join(f"{s},{n},{q}\n" for s, n, q in found), " ".join(w for k, w in enumerate(words) if k not in gone))]
        want.append((i, len(found), *best, best[1] and 1000 * best[1] // best[2], *digests))
    got = runs.run_digests(runs.periodic_runs(runs.planted(documents(spark, rows))))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert runs.run_digests(runs.periodic_runs(runs.planted(documents(spark, []).limit(0)))).collect() == []


# ------------------------------------------------------------------ source divergence


def brute_divergence(rows, least, top):
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang, source].update(found)
        seen[lang].update(set(found))
    out = []
    for lang in {g[0] for g in counts}:
        kept = sorted(t for t, n in seen[lang].items() if n >= least)
        groups = {s: counts[g, s] for g, s in counts if g == lang}

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in groups.items()}, share(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(ranked)]
    return sorted(out)


def term_rows(seed, n=400):
    rng = random.Random(seed)
    words = ["The", "the", "É", "é", "a1b", "x_y", "Zed", "中文"] + [f"w{chr(97 + i)}" for i in range(15)]
    rows = [(rng.choice(["en", "en", "de", None]), rng.choice(["hot", "hot", "s1", "s2", "S3", None]),
             " ".join(rng.choices(words, k=rng.randint(0, 12)))) for _ in range(n)]
    return rows + [("xx", "one", None), ("xx", "two", "42"), ("yy", "alone", "word " * 20_000), ("en", "silent", "rare7")]


def sources(spark, rows):
    return spark.createDataFrame([(l, s, t, 1, "x", 2) for l, s, t in rows],
                                 "lang string, source string, text string, p int, item string, rank int")


@pytest.mark.parametrize("least, top", [(1, 3), (30, 50)])
def test_divergence_against_brute_force(spark, least, top):
    rows = term_rows(least)
    got = divergence.source_divergence(sources(spark, rows), min_docs=least, top=top)
    assert got.dtypes[-2:] == [("value", "bigint"), ("rank", "int")]
    assert sorted(tuple(r) for r in got.collect()) == brute_divergence(rows, least, top)


def test_divergence_hands_on_what_it_cannot_hold(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 3)
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 200)
    rows = term_rows(5, 150)
    got = divergence.source_divergence(sources(spark, rows), min_docs=2, top=5)
    assert sorted(tuple(r) for r in got.collect()) == brute_divergence(rows, 2, 5)


def test_divergence_of_nothing(spark):
    assert divergence.source_divergence(sources(spark, []).limit(0)).collect() == []


def test_tree_shares_paths():
    """Each node is compared with its ancestors once, with the number of rows below it."""
    paths = [([(1, 9, 50, 10), (3, 1, 40, 20)], 5), ([(1, 9, 50, 10), (3, 1, 40, 20), (4, 2, 70, 30)], 2), ([(1, 9, 50, 10), (4, 2, 70, 30)], 1), ([(2, 1, 5, 1)], 9)]

    def more(a, b):
        return abs(a[2] - b[2]) - abs(a[2] - b[3]) - abs(a[3] - b[2]) + abs(a[3] - b[3])

    want = Counter()
    for path, m in paths:
        for k, b in enumerate(path):
            for a in path[:k]:
                want[a[0], b[0]] += m * more(a, b)
    columns = [np.array([i[c] for path, _ in paths for i in path]) for c in range(4)]
    out = list(divergence.pair_sums(np.array([len(p) for p, _ in paths]), *columns, np.array([m for _, m in paths])))
    got = Counter()
    for a, b, value in out:
        got.update({(int(x), int(y)): int(v) for x, y, v in zip(a, b, value)})
    assert got == want and sum(len(a) for a, _, _ in out) == 3
