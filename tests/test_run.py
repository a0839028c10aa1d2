"""The whole run: states, resume, failures, headers, logs."""

import pytest
from pyspark.sql import functions as F

from worklink.operators.labels import LabellerDown
from worklink.plans import open_roles as jobs_report
from worklink.plans import pipeline
from worklink.plans import seeker_profile as seekers_report
from worklink.session import case_sensitive
from worklink.sinks import runlog
from worklink.sinks.versions import read_current
from worklink.workload.bindings import bind
from worklink.workload.queries import deny_table, place_labeller

DATA = "/root/testdata/sf0.001"
REPORTS = ["OPEN_ROLES", "job_application", "seeker_profile"]


@pytest.fixture(scope="module")
def raw(spark):
    """Raw documents of a few rows per table, in both states."""
    few = {"user_seeker": "user_seeker", "member_seeker": "member", "user_provider": "user_provider"}
    tables = {n: bind(spark, DATA, b) for n, b in few.items()}
    organization = bind(spark, DATA, "organization").select(
        "state", "side", "id", "name", F.to_json(F.struct(F.col("contact_phone").alias("phone"))).alias("metadata"))
    tables |= {f"org_{s}": organization.filter(F.col("side") == s) for s in ("seeker", "provider")}
    tables["member_provider"] = tables["member_seeker"].limit(6)
    tables["profile"] = bind(spark, DATA, "raw_profile").withColumns({
        "user_id": F.concat(F.lit("U"), F.col("id")), "created_at": F.lit("2001-07-01")})
    tables["job_posting"] = bind(spark, DATA, "raw_posting").withColumns({
        "status": F.lit("open"), "organization_name": F.col("title"), "organization_id": F.col("id"),
        "created_by": F.concat(F.lit("P"), F.col("id")), "created_at": F.lit("2001-08-01"), "location": F.lit("{}")})
    apps = bind(spark, DATA, "job_application").select(
        "state", "id", "job_id", "user_id", "transaction_id", "user_name", "status", "application_status", "applied_at",
        "updated_at", "contact", "location", "metadata")
    tables["job_application"] = apps.filter("cast(id as int) % 5 = 0")
    return {n: df.cache() for n, df in tables.items()}


@pytest.fixture(scope="module")
def world(spark):
    places = bind(spark, DATA, "gazetteer").withColumnRenamed("text", "value")
    return {"deny": deny_table(spark, DATA), "places": places, "roles": bind(spark, DATA, "taxonomy"), "as_of": "2001-08-15"}


def current(spark, root, name):
    return read_current(spark, f"{root}/prod/{name}")


def counts(spark, root, name):
    return {r.state: r["count"] for r in current(spark, root, name).groupBy("state").count().collect()}


@pytest.fixture(scope="module")
def full_run(spark, raw, world, tmp_path_factory):
    """One run of both states, which the tests below start from."""
    root = str(tmp_path_factory.mktemp("run"))
    return root, pipeline.run(spark, raw, root, **world, headers={"seeker_profile": ["Trade", "name", "unknown", "id", ""]})


def test_states_and_resume(spark, raw, world, full_run):
    root, result = full_run
    assert result.errors == [] and result.skipped == [] and set(result.reports) == {"matches", *REPORTS}
    full = {n: counts(spark, root, n) for n in ["matches", *REPORTS]}
    assert all(set(full[n]) == {"KA", "UP"} for n in REPORTS)
    log = spark.read.parquet(f"{root}/prod/_log").first()
    assert len([c for c in log.asDict() if c[:3] in ("ka_", "up_")]) == 18
    assert log.ka_profile + log.up_profile == 150 and log.errors == ""
    want = {r.name: r.n_rows for r in runlog.state_counts({t: read_current(spark, f"{root}/processed/flagged/{t}") for t in raw}).collect()}
    assert {k: v for k, v in log.asDict().items() if k[:3] in ("ka_", "up_")} == {f"{s}_{t}": want.get(f"{s}_{t}", 0) for s in ("ka", "up") for t in raw}
    history = spark.read.parquet(f"{root}/prod/_history").first()
    assert (history.ka_matches, history.up_matches) == tuple(full["matches"].get(s, 0) for s in ("KA", "UP"))
    assert set(counts(spark, root, "tables/user_seeker")) == {"KA", "UP"}

    # published headers, in the order of the destination; some differ by case only
    with case_sensitive(spark):
        tab = current(spark, root, "tabs/seeker_profile")
        published = [h for h in seekers_report.HEADERS.values()]
        assert tab.columns[:5] == ["state", "Trade", "name", "unknown", "id"] and set(tab.columns) == {"state", "Trade", "unknown", *published}
        assert tab.count() == sum(full["seeker_profile"].values()) and tab.filter("coalesce(unknown, '') <> ''").isEmpty()
        names = {r.id: r.name for r in current(spark, root, "seeker_profile").collect()}
        assert {r.id: r.name or "" for r in tab.collect()} == {k: v or "" for k, v in names.items()}
        jobs = current(spark, root, "tabs/OPEN_ROLES")
        assert jobs.columns == ["state", *jobs_report.HEADERS.values()]

    # a run of both states that resumes builds what one of them lacks
    runlog.forget(spark, f"{root}/prod/_manifest", ["UP"])
    resumed = pipeline.run(spark, raw, root, **world, resume=True)
    assert set(resumed.reports) == set(full) and resumed.skipped == sorted(("KA", n) for n in full)
    assert {n: counts(spark, root, n) for n in full} == full
    assert spark.read.parquet(f"{root}/prod/_history").select("ka_matches", "up_matches").distinct().count() == 1


def test_a_state_that_became_empty(spark, raw, world, full_run):
    """In a full run and in a run of that state: empty in stages, reports, tabs, manifest and counts."""
    root, few = full_run[0], {t: raw[t] for t in pipeline.NEEDS["OPEN_ROLES"]}

    def states(name, folder="prod"):
        return set(r.state for r in read_current(spark, f"{root}/{folder}/{name}").select("state").distinct().collect())

    def without(state):
        return {t: df.filter(F.col("state") != state) for t, df in few.items()}

    assert states("OPEN_ROLES") == {"KA", "UP"}
    for run_states, gone, left in ((None, "KA", {"UP"}), (["UP"], "UP", set())):
        result = pipeline.run(spark, without(gone), root, **world, states=run_states)
        assert set(result.reports) == {"OPEN_ROLES"}
        for name in ("OPEN_ROLES", "tabs/OPEN_ROLES", "tables/profile"):
            assert states(name) == left, name
        for step in ("flat", "labelled", "flagged"):
            assert states(f"{step}/job_posting", "processed") == left, step
        assert runlog.done_counts(spark, f"{root}/prod/_manifest", "OPEN_ROLES", [gone]) == {gone: 0}
        log = spark.read.parquet(f"{root}/prod/_log").orderBy(F.desc("run_timestamp")).collect()
        assert any(r[f"{gone.lower()}_profile"] == 0 for r in log if f"{gone.lower()}_profile" in r.asDict())


def test_a_lost_table_is_noted(spark, raw, world, tmp_path):
    broken = dict(raw) | {"org_provider": raw["org_provider"].drop("metadata")}
    result = pipeline.run(spark, broken, str(tmp_path), **world, states=["KA"])
    assert set(result.reports) == {"matches", "OPEN_ROLES", "seeker_profile"}
    assert result.errors[0].startswith("org_provider: ") and any(e.startswith("job_application: needs org_provider") for e in result.errors)
    log = spark.read.parquet(f"{tmp_path}/prod/_log").first()
    assert log.ka_org_provider == 0 and "org_provider" in log.errors and log.ka_profile > 0


def test_a_dead_labeller_ends_the_run(spark, raw, world, tmp_path):
    def dead(texts):
        raise OSError("no connection")

    with pytest.raises(LabellerDown):
        pipeline.run(spark, raw, str(tmp_path), **world | {"places": dead})


def test_the_first_batch_is_asked_once(spark, tmp_path):
    from worklink.operators.labels import label_distinct

    asked = spark.sparkContext.accumulator(0)

    def count(texts):
        asked.add(len(texts))
        return place_labeller(texts)

    values = spark.createDataFrame([(f"d{i}, s",) for i in range(30)], "value string")
    rows = label_distinct(values, count, ["state", "district"], batch=10, check_first=True).collect()
    assert len(rows) == 30 == asked.value and all(r.state == "s" for r in rows)
