"""Labels: one join for several columns, a store that outlives a run, ranks."""

import random

import pytest
from pyspark.sql import functions as F

from worklink.constants import ROLE_FIELDS
from worklink.operators import labels
from worklink.operators.keyed import ranked


def lookup(spark):
    return spark.createDataFrame([(v, *[f"{v}-{f}" for f in ROLE_FIELDS]) for v in ("welder", "driver")],
                                 "value string, " + ", ".join(f"{f} string" for f in ROLE_FIELDS))


def test_three_columns_take_one_join_of_the_table(spark):
    rows = [(str(i), *random.Random(i).choices([" welder", "driver", "other", "", None], k=3)) for i in range(200)]
    table = spark.createDataFrame(rows, "id string, role string, title string, job_title string")
    out = labels.apply_taxonomy(table.withColumn("llm_role_sector", F.lit("old")), ["role", "title", "job_title", "lost"], lookup(spark))
    got = {r.id: r for r in out.collect()}
    assert len(got) == 200 and out.columns[:4] == table.columns and len(out.columns) == 4 + 4 * len(ROLE_FIELDS)
    for i, *values in rows:
        for c, v in zip(("role", "title", "job_title"), values):
            known = v.strip() if v and v.strip() in ("welder", "driver") else None
            assert got[i][f"llm_{c}_normalized"] == (known and f"{known}-role") and got[i][f"llm_{c}_sector"] == (known and f"{known}-sector")
        assert got[i].llm_lost_normalized is None
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2  # one with the lookup, one with the table


@pytest.mark.parametrize("fails", [False, True])
def test_a_second_run_sends_only_unseen_texts(spark, tmp_path, fails):
    asked = spark.sparkContext.accumulator(0)

    def labeller(texts):
        if fails and "bad" in texts:
            raise OSError("no answer")
        asked.add(len(texts))
        return [{"state": t.upper()} for t in texts]

    def run(*texts):
        values = spark.createDataFrame([(t,) for t in texts], "value string")
        before = asked.value
        rows = labels.stored_labels(values, labeller, ["state"], str(tmp_path / "store"), batch=1, concurrency=1)
        got = {r.value: r.state for r in rows.collect()}
        return got, asked.value - before

    assert run("a", "b") == ({"a": "A", "b": "B"}, 2)
    assert run("a", "b") == ({"a": "A", "b": "B"}, 0)
    assert run("b", "c", "bad") == ({"b": "B", "c": "C", "bad": None if fails else "BAD"}, 1 if fails else 2)
    # a text without an answer is sent again
    assert run("c", "bad")[1] == 0 and run()[0] == {}


def test_global_ranks(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["KA", "UP", None]), rng.randint(0, 9), i) for i in range(500)]
    frame = spark.createDataFrame(rows, "state string, score int, id int").repartition(7)
    got = {r.id: r["rank"] for r in ranked(frame, ["state"], [F.desc("score"), F.asc("id")]).collect()}
    for state in ("KA", "UP", None):
        own = sorted((r for r in rows if r[0] == state), key=lambda r: (-r[1], r[2]))
        assert [got[r[2]] for r in own] == list(range(1, len(own) + 1))
    plan = ranked(frame, ["state"], [F.desc("score"), F.asc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert ranked(frame.limit(0), ["state"], [F.asc("id")]).collect() == []


def test_ranks_shuffle_their_rows_once(spark):
    """the stored ranges hold the numbers, so the second step only reads; a rank starts anew within a range."""
    rows = [("KA" if i % 7 else "UP", i % 5, i) for i in range(3000)]
    frame = spark.createDataFrame(rows, "state string, score int, id int")
    placed = ranked(frame, ["state"], [F.desc("score"), F.asc("id")])
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
    own = sorted((r for r in rows if r[0] == "UP"), key=lambda r: (-r[1], r[2]))
    assert {r.id: r["rank"] for r in placed.filter("state = 'UP'").collect()} == {r[2]: i + 1 for i, r in enumerate(own)}
