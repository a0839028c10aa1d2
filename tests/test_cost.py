"""Costs per row: formats of dates, keys of sorts, fields of documents."""

import json

from pyspark.sql import functions as F

from worklink.functions import text as X
from worklink.operators import extract
from worklink.operators.keyed import skew_join
from worklink.plans.pipeline import OPEN_ROLES_FIELDS, clean

STAMPS = [
    None, "", "  ", "soon", "a.b", "a:b", "2025", "2025-1", "2025-1-2", " 2025-01-02 ", "25-1-2", "02025-1-2", "12025-1-2", "+12025-1-2",
    "-2025-1-2", "0000-1-1", "2025-13-1", "2025-2-30", "2024-2-29", "2025-1-2T3:4:5", "2025-1-2 3:4", "2025-1-2 3:4:5", "2025-01-02 24:00:00",
    "2025-01-02 23:59:60", "2025-1-2 3:4:5.", "2025-1-2 3:4:5.5", "2025-1-2 3:4:5.123456", "2025-1-2 3:4:5.1234567", "2025-1-2  3:4:5",
    "2025-01-02 03:04:05+00:00", "2025-01-02 03:04:05Z", "2025-01-02 03:04:05 UTC", "2025-1-2 3:4:5\n", "2025-1-2\nx", "２025-1-2", "2025-1-2 3:4:5,5",
]


def test_timestamps_try_one_format(spark):
    """the same values as all formats one after the other, without trying those that cannot fit."""
    text = X.strip(F.col("t"))
    each = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in X.TIMESTAMP_FORMATS])
    df = spark.createDataFrame([(t,) for t in STAMPS], "t string").select(
        "t", F.unix_micros(X.timestamp_of(F.col("t"))).alias("got"), F.unix_micros(each).alias("want"))
    assert [r.t for r in df.collect() if r.got != r.want] == []
    plan = spark.range(1).select(X.timestamp_of(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert "coalesce(" not in plan


def test_skew_join_sorts_by_the_hash(spark):
    """a state as first key makes a sort compare whole texts."""
    df = spark.createDataFrame([("KA", "1", 2)], "state string, id string, n int")
    joined = skew_join(df.hint("merge"), df.withColumnRenamed("n", "m"), ["state", "id"])
    assert joined.columns == ["state", "id", "n", "m"]
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [_h#" in plan


def test_run_reads_the_fields_of_its_report(spark):
    """only fields of later steps, with the values they have among all; other objects are not opened."""
    inner = {"jobTitle": "Fitter ", "natureOfJob": "daily", "minMonthlyInHand": "", "minSalary": 9000, "positions": [], "openings": "2"}
    docs = [{"jobDetails": json.dumps(inner), "jobNeeds": {"educationSubsection": {"minEducationLevel": ["ITI", " "]}, "locationPreference": {"city": "x"}},
             "basicInfo": {"jobProviderLocation": {"city": "", "tag": "Mysuru", "gps": {"lat": 1}}}}, {"jobDetails": inner, "role": "Welder"}]
    rows = [(str(i), "t", "d", json.dumps(doc)) for i, doc in enumerate(docs)] + [("n", " ", None, None), ("x", "t", "", "[1]")]
    raw = spark.createDataFrame(rows, "id string, title string, description string, metadata string")
    got = clean({"job_posting": raw}, OPEN_ROLES_FIELDS)["job_posting"]
    assert got.columns == ["id", "title", "description", *[c for c in extract.flatten_posting(raw).columns if c in OPEN_ROLES_FIELDS["job_posting"]]]
    assert got.orderBy("id").collect() == extract.flatten_posting(raw).select(*got.columns).orderBy("id").collect()
    assert "natureOfJob" not in got._jdf.queryExecution().optimizedPlan().toString()
