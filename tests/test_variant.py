"""JSON semantics: presence chains, nested texts, lists and scalars."""

import json

import pytest
from pyspark.sql import functions as F

from worklink.functions import variant as V
from worklink.operators import extract
from worklink.operators.fieldmap import FIELD_MAPS


def doc(spark, text):
    return spark.createDataFrame([(text,)], "j string").select(V.parse_obj(F.col("j")).alias("v"))


@pytest.mark.parametrize("literal, present", [
    ("null", False), ('""', False), ("0", False), ("0.0", False), ("-0", False), ("0e5", False),
    ("false", False), ("[]", False), ("{}", False), ('"0"', True), ('"false"', True), ('"[]"', True),
    ("[null]", True), ('{"a":null}', True), ("0.01", True), ("true", True), ('" "', True),
])
def test_truthy(spark, literal, present):
    df = doc(spark, f'{{"k": {literal}}}')
    assert df.select(V.truthy(V.get(F.col("v"), "k"))).first()[0] is present
    assert df.select(V.truthy(V.get(F.col("v"), "missing"))).first()[0] is False


@pytest.mark.parametrize("text", [None, "", "{}x", "[]", "[1]", "nope", '"s"', "5", '{"a": NaN}'])
def test_parse_obj_rejects(spark, text):
    assert doc(spark, text).filter("v is not null").isEmpty()


def test_duplicate_keys_last_wins(spark):
    assert doc(spark, '{"a":1,"a":2}').select(V.get_text(F.col("v"), "a")).first()[0] == "2"


def flat(spark, table, **columns):
    row = {k: json.dumps(v) if isinstance(v, dict) else v for k, v in columns.items()}
    schema = ", ".join(f"{k} string" for k in row)
    df = spark.createDataFrame([tuple(row.values())], schema)
    step = {"profile": extract.flatten_profile, "job_posting": extract.flatten_posting,
            "job_application": extract.flatten_application,
            "organization": extract.flatten_organization}[table]
    return step(df).first().asDict()


def test_profile(spark):
    got = flat(spark, "profile", id="1", status="raw", metadata={
        "name": "", "age": 0, "status": "meta", "whoIAm": json.dumps({
            "name": " Asha ", "phone": 9876543210, "age": 31, "locationData": {"city": "Mysuru"}}),
        "whatIHave": {"itiSpecialization": ["Fitter", " ", None, "Welder "], "consent for physical health": "yes",
                      "workExperience": [{"y": 1}], "assessmentScores": "x"},
        "education": [{"a": 1}, "b"], "isAadharVerified": 1,
    })
    assert got["name"] == "Asha" and got["age"] == "31" and got["phone"] == "+919876543210"
    assert got["location_city"] == "Mysuru" and got["iti_specialization"] == "Fitter|Welder"
    assert got["consent_physical_health"] is True and got["is_aadhar_verified"] is True
    assert got["is_gender_verified"] is None and got["education"] == '{"a":1}|b'
    assert json.loads(got["work_experience"]) == [{"y": 1}] and got["assessment_scores"] == '"x"'
    assert got["status"] == "raw" and got["status_meta"] == "meta"
    assert len(got) == 3 + 94


@pytest.mark.parametrize("nature, low, high", [
    ("Summer Internship", "1", "2"), ("Gig work", "3", "4"), ("Permanent", "5", "6"), (None, "5", "6"),
])
def test_posting_salary_basis(spark, nature, low, high):
    got = flat(spark, "job_posting", id="1", title="Fitter", description="d", metadata={"jobDetails": {
        "natureOfJob": nature, "stipendMin": 1, "stipendMax": 2, "taskRateMin": 3, "taskRateMax": 4,
        "minMonthlyInHand": 0, "minSalary": 5, "maxCTC": 6}})
    assert (got["unified_salary_min"], got["unified_salary_max"]) == (low, high)
    assert got["role"] == "Fitter" and got["job_description"] == "d"


def test_application(spark):
    got = flat(spark, "job_application", id="1", user_name=None, contact={"phone": "", "email": " a@b "},
               location={"city": {"code": "x", "name": "Agra"}, "state": "UP", "gps": {"lat": 1.5}},
               metadata={"name": "N", "metadata": json.dumps({"whoIAm": {"phone": "0919876543210"}}),
                         "jobDetails": {"jobDetails": {"positions": 4}, "location": {"a": 1}}})
    assert got["seeker_phone"] == "+919876543210" and got["seeker_email"] == "a@b"
    assert got["app_location_city"] == "Agra" and got["app_location_state"] == "UP"
    assert got["app_location_lat"] == "1.5" and got["job_openings"] == "4"
    assert got["seeker_name"] == "N" and got["job_location"] == '{"a":1}'


def test_counts():
    sizes = {t: len(f) for t, f in FIELD_MAPS.items()}
    assert sizes == {"profile": 94, "organization": 7, "job_posting": 85, "job_application": 58}


def test_documents_are_parsed_once(spark):
    df = extract.flatten_profile(spark.createDataFrame([("1", "{}")], "id string, metadata string"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json(metadata") + plan.count("parseJson(metadata") <= 1


@pytest.mark.parametrize("table, step, most", [
    ("job_application", extract.flatten_application, 200), ("job_posting", extract.flatten_posting, 250)])
def test_an_objects_members_are_read_at_once(spark, table, step, most):
    roots = sorted({p.root for f in FIELD_MAPS[table] for p in f.paths})
    df = step(spark.createDataFrame([tuple("{}" for _ in roots)], ", ".join(f"{r} string" for r in roots)))
    key = "spark.sql.debug.maxToStringFields"
    shown = spark.conf.get(key)
    spark.conf.set(key, "100000")
    reads = df._jdf.queryExecution().optimizedPlan().toString().count("try_variant_get(")
    spark.conf.set(key, shown)
    assert 0 < reads <= most


def test_members_that_differ_by_case_and_lists(spark):
    details = {"monthlyAverageOT": 0, "monthlyAverageOt": "12", "jobType": ["a ", None, " "], "modeOfWork": "[x]"}
    got = flat(spark, "job_posting", title="t", description="d", metadata={"jobDetails": json.dumps(details)})
    assert got["monthly_average_ot"] == "12" and got["job_type"] == "a" and got["mode_of_work"] == "[x]"
