"""Similarity join, signature matching and skew handling against brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from worklink.operators import matching, similarity
from worklink.operators.keyed import first_org_per_user, first_per_key, key_rows, product_join, result_sizes, skew_join


def slow_lcs(a, b):
    line = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(new[-1], line[j + 1], line[j] + (x == y)))
        line = new
    return line[-1]


def slow_ratio(a, b):
    s, t = set(a.split()), set(b.split())
    if not s or not t:
        return 0.0
    common = s & t
    if common and (s <= t or t <= s):
        return 100.0
    left, right = " ".join(sorted(s - t)), " ".join(sorted(t - s))
    size = len(" ".join(sorted(common)))
    gap = 1 if size else 0
    la, lb = size + gap + len(left), size + gap + len(right)

    def sim(d, n):
        return 100 - 100 * d / n

    best = sim(len(left) + len(right) - 2 * slow_lcs(left, right), la + lb)
    if size:
        best = max(best, sim(gap + len(left), size + la), sim(gap + len(right), size + lb))
    return best


WORDS = "cnc operator machine diesel mechanic electrician fitter welder driver helper QC x".split()


def texts(n, seed):
    rng = random.Random(seed)
    return sorted({" ".join(rng.choices(WORDS, k=rng.randint(1, 4))) for _ in range(n)})


@pytest.mark.parametrize("a, b, score", [
    ("CNC Operator", "Machine Operator", 80.0), ("Diesel Mechanic", "Mechanic", 100.0),
    ("mechanic", "Diesel Mechanic", 60.87), ("Electrician", "Fitter", 23.53), ("", "x", 0.0),
    ("a b", "b a", 100.0), ("a a b", "b a", 100.0), ("x" * 300, "x" * 299 + "y", 99.67),
])
def test_token_set_vectors(spark, a, b, score):
    assert ratios(spark, [(a, b)]) == [pytest.approx(score, abs=0.006)]


def ratios(spark, pairs):
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    return [r.score for r in similarity.token_set_ratio("a", "b", rows, "score").orderBy("i").collect()]


def test_token_set_matches_brute_force_and_is_symmetric(spark):
    pairs = list(itertools.product(texts(60, 1), texts(60, 2) + ["é" * 70 + " w", "\0 b", "x\x1cy"]))
    got = ratios(spark, pairs)
    assert got == pytest.approx([slow_ratio(x, y) for x, y in pairs])
    assert got == pytest.approx(ratios(spark, [(y, x) for x, y in pairs]))


@pytest.mark.parametrize("sizes", [(0, 5), (1, 62), (60, 64), (50, 300)])
def test_common_subsequence_of_any_length(spark, sizes):
    rng = random.Random(sizes[1])
    pairs = [["".join(rng.choices("abcé😀 \0", k=rng.randint(*sizes))) for _ in "ab"] for _ in range(60)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = frame.select("i", similarity.common_length(F.col("a"), F.col("b")).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [slow_lcs(*p) for p in pairs]


@pytest.mark.parametrize("floor", [0.0, 0.3, 0.5, 0.8])
def test_similarity_join_is_exact(spark, floor):
    left, right = texts(80, 3) + ["FITTER", "zz"], texts(80, 4)
    frames = [spark.createDataFrame([(v,) for v in vs], "value string") for vs in (left, right)]
    rows = similarity.scored_pairs(*frames, floor).collect()
    got = {(r.left_value, r.right_value): r.score for r in rows}
    want = {}
    for a, b in itertools.product(left, right):
        score = 1.0 if a.lower() == b.lower() else slow_ratio(a, b) / 100
        if score >= floor:
            want[a, b] = pytest.approx(score)
    assert len(rows) == len(got) and got == want


def test_similarity_join_has_no_product(spark):
    frame = spark.createDataFrame([("a b",), ("c",)], "value string")
    plan = similarity.scored_pairs(frame, frame, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in ("CartesianProduct", "NestedLoopJoin", "Python", "Arrow"))


def market(spark, n=60):
    rng = random.Random(7)
    pick = rng.choice
    roles = ["cnc operator", "machine operator", "welder", "arc welder", "driver"]
    sk = [(str(i), f"U{i}", pick(["KA", "UP"]), pick([*roles, "welder|driver", ""]) if i % 3 else "welder",
           pick(roles + [None]), pick(["karnataka", "up", ""]), pick(["a", "b", None]),
           pick(["9000", "15000", None, "bad"]), pick(["ITI", "10th", None]), pick(["0", "0", "1", None]))
          for i in range(n)]
    pr = [(str(i), pick(["KA", "UP"]), pick(["open", " Open", "closed"]), pick(roles) if i % 3 else "welder",
           pick(["karnataka", "Up", None]), pick(["a", "c", ""]), pick(["8000", None]),
           pick(["12000", None]), pick(["ITI", "graduate", None]), pick(["0", "0", "1", None]))
          for i in range(n)]
    seekers = spark.createDataFrame(sk, "id string, user_id string, state string, iti_specialization string, "
        "role string, llm_location_state string, llm_location_district string, monthly_in_hand_preferred string, "
        "highest_qualification string, test_flag string")
    jobs = spark.createDataFrame(pr, "id string, state string, status string, title string, llm_location_state string, "
        "llm_location_district string, min_monthly_in_hand string, max_monthly_in_hand string, "
        "min_education_level string, test_flag string")
    return seekers, jobs


def test_counts_equal_expanded_pairs(spark):
    seekers, jobs = market(spark)
    pairs = matching.match(seekers, jobs).toPandas()
    assert len(pairs) and not pairs.duplicated(["seeker_id", "provider_job_id"]).any()
    assert pairs.confidence.between(0.4, 1).all()
    for by, key in (("job", "provider_job_id"), ("seeker", "seeker_id")):
        got = matching.fit_counts(seekers, jobs, by).toPandas().set_index(key).sort_index()
        want = pairs.groupby(key).match_category.value_counts().unstack(fill_value=0)
        assert got.right_fit.to_dict() == want["Right Fit"].to_dict()
        assert got.partial_fit.to_dict() == want["Partial Fit"].to_dict()


def places(spark, n=90):
    """Jobs and seekers whose states and districts hold each other, miss, or differ."""
    rng = random.Random(11)
    seekers, jobs = market(spark, n)
    states, districts = ["karnataka", "karna", "up", "", None], ["north a", "a", "b", "", None]
    put = {"llm_location_state": states, "llm_location_district": districts}

    def redone(df, more):
        rows = [r.asDict() | {c: rng.choice(v) for c, v in (put | more).items()} for r in df.collect()]
        return spark.createDataFrame([tuple(r[c] for c in df.columns) for r in rows], df.schema)

    return (redone(seekers, {"monthly_in_hand_preferred": ["5000", "9000", "11000", "14500", "90000", None]}),
            redone(jobs, {"max_monthly_in_hand": ["12000", "30000", None], "min_education_level": ["8th", "graduate", "mba", None]}))


@pytest.mark.parametrize("by", ["job", "seeker"])
def test_counts_need_no_pairs_of_signatures(spark, monkeypatch, by):
    seekers, jobs = places(spark)
    sk, pr = matching.keyed_seekers(seekers), matching.keyed_jobs(jobs)
    scored = matching.stage(matching.scored_signatures(sk, pr))
    want = matching.fit_counts(seekers, jobs, by, scored).collect()
    assert {r.confidence < 0.6 for r in scored.collect()} == {True, False}
    monkeypatch.setattr(matching, "scored_signatures", None)
    assert sorted(matching.fit_counts(seekers, jobs, by).collect()) == sorted(want)


def test_scores_of_a_pair_are_computed_once(spark):
    seekers, jobs = market(spark, 12)
    roles = spark.createDataFrame([("welder", "welder", 1.0, "welder")], "sk_key string, pr_role string, role_score double, best_trade string")
    scored = matching.scored_signatures(matching.keyed_seekers(seekers), matching.keyed_jobs(jobs), roles)
    plan = scored._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("contains(") == 4  # the texts of one location score


def test_totals_need_no_pairs(spark, monkeypatch):
    seekers, jobs = places(spark)
    pairs = matching.match(seekers, jobs).groupBy("state", "match_category").count().collect()
    monkeypatch.setattr(matching, "scored_signatures", None)
    assert sorted(matching.match_totals(seekers, jobs).collect()) == sorted(pairs)
    one = [r for r in pairs if r.state == "KA"]
    assert sorted(matching.match_totals(seekers, jobs, ["KA"]).collect()) == sorted(one)


def test_pairs_are_made_where_they_are_scored(spark, monkeypatch):
    """the rows of `expand`, also of a signature with many and repeated rows, without a shuffle of pairs."""
    seekers, jobs = places(spark, 40)
    hot = seekers.filter("test_flag = '0' and iti_specialization = 'welder'").limit(1)
    copies = spark.range(20).selectExpr("concat('c', id % 15) as id")
    seekers = seekers.union(hot.drop("id").crossJoin(copies).select(*hot.columns))
    monkeypatch.setattr(matching, "PACK_ROWS", 4)
    sk, pr = matching.keyed_seekers(seekers), matching.keyed_jobs(jobs)
    want = matching.expand(
        matching.stage(matching.scored_signatures(sk, pr)),
        sk.select(*matching.SEEKER_SIGNATURE, F.col("id").alias("seeker_row"), F.col("user_id").alias("seeker_id")),
        pr.select(*matching.JOB_SIGNATURE, F.col("id").alias("provider_job_id")))
    got = matching.match(seekers, jobs)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect())) != []
    packs = matching._packed(sk.select(*matching.SEEKER_SIGNATURE, "id"), matching.SEEKER_SIGNATURE, "seekers").collect()
    assert max(len(p.seekers) for p in packs) == 4 and sum(len(p.seekers) for p in packs) == sk.count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not {"Join", "Repartition"} & set(plan[:plan.index("explode(seekers")].replace("+-", " ").split())


def skewed(spark):
    rows = [(i, "hot" if i % 3 == 0 else (None if i % 3 == 1 else f"k{i % 50}")) for i in range(3000)]
    left = spark.createDataFrame(rows, "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("k2", 2), ("k5", 3), ("unused", 4)], "k string, v int")
    return left, right


def as_rows(df):
    return sorted(map(str, df.select("id", "k", "v").collect()))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skew_join_equals_plain_join(spark, how):
    left, right = skewed(spark)
    assert as_rows(skew_join(left, right, ["k"], how)) == as_rows(left.join(right, "k", how))


def test_skew_join_splits_a_hot_key(spark):
    """A key with most rows reaches several tasks, also next to a side that is grouped by the key."""
    saved = {k: spark.conf.get(k) for k in (
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for key, value in zip(saved, ("20k", "20k", "-1", "16")):
            spark.conf.set(key, value)
        left = spark.range(60_000).repartition(12).selectExpr("id", "if(id % 10 < 9, 'hot', string(id % 97)) as k", "repeat('x', 20) as pad")
        right = left.groupBy("k").agg(F.count(F.lit(1)).alias("v"))
        sizes = skew_join(left, right, ["k"]).groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in sizes) < 30_000
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("task_rows", [100, 10 ** 6])
def test_product_join_equals_plain_join(spark, task_rows):
    left, right = skewed(spark)
    right = right.union(right.selectExpr("k", "v + 10"))
    assert as_rows(product_join(left, right, ["k"], ["id"], task_rows)) == as_rows(left.join(right, "k"))


def test_product_join_bounds_a_hot_key(spark):
    """A key with most of the result is cut into pieces of a task's share; sizes of several joins come from one pass."""
    left = spark.range(8000).selectExpr("id", "if(id % 10 < 9, 'hot', string(id % 97)) as k")
    right = spark.range(300).selectExpr("if(id % 3 > 0, 'hot', string(id % 97)) as k", "cast(id as int) as v")
    sides = (key_rows(left, ["k"]), key_rows(right, ["k"]))
    sizes = result_sizes({"all": sides, "none": (key_rows(left.limit(0), ["k"]), sides[1])}, 50_000)
    assert sizes["none"].rows == 0 and len(sizes["all"].hot) == 1
    joined = product_join(left, right, ["k"], ["id"], 50_000, sizes["all"])
    assert joined.count() == sizes["all"].rows == left.join(right, "k").count()
    tasks = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in tasks) < 300_000 < 7200 * 200


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), ("a", "w", 3), ("b", None, 4)], "k string, o string, n int")
    assert {r.k: r.n for r in first_per_key(df, ["k"], ["o", "n"]).collect()} == {"a": 3, "b": 4}


def test_first_is_the_first_created(spark):
    """The order of the rows decides, not that of what is looked up; a null in the first row stays."""
    rows = [("a", "2001-02-01", "1", "aaa"), ("a", "2001-01-01", "9", None), ("a", None, "0", "bbb"), ("b", "2001-01-01", "2", "z"), ("b", "2001-01-01", "1", "y")]
    df = spark.createDataFrame(rows, "k string, created_at string, id string, v string")
    assert {r.k: r.v for r in first_per_key(df, ["k"], ["v"]).collect()} == {"a": None, "b": "y"}
    members = spark.createDataFrame(
        [("u", "5", "2001-03-01"), ("u", "9", "2001-01-01"), ("u", None, "2000-01-01"), ("w", None, "2000-01-01"), (None, "1", "2000-01-01")],
        "user_id string, organization_id string, created_at string")
    assert {r.user_id: r.organization_id for r in first_org_per_user(members).collect()} == {"u": "9", "w": None}
