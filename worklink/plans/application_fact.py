"""Application fact table (RUL-32, JN-11..JN-16, PRJ-14).

The reports look up seven tables by two keys of an application. The lookups
are first joined among themselves, so that the large table is shuffled once
for the job and once for the applicant instead of seven times.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklink.functions.text import as_text, display_phone, fmt_date, to_num_text
from worklink.operators.keyed import FIRST_BY, first_org_per_user, first_per_key, skew_join
from worklink.operators.stats import timestamp_column

# fixed values: report column -> header of the published table
HEADERS = {
    "id": "id", "job_id": "job_id", "transaction_id": "transaction_id", "status": "status",
    "application_status": "application_status", "user_name": "user_name", "user_id": "user_id",
    "location": "location", "contact": "contact", "metadata": "metadata",
    "applied_at": "applied_at", "updated_at": "updated_at", "phone": "Contact Number",
    "formatted_phone": "Formatted Phone Number", "company_name": "Company Name",
    "location_copy": "Location", "test_flag": "Test Flag", "user_phone": "user_phone",
    "user_email": "user_email", "user_district": "user_district", "user_state": "user_state",
    "job_role": "job role", "institution_name": "institution name",
    "institution_id": "institution id", "contact_name": "contact name",
    "contact_number": "contact number", "contact_email": "contact email",
    "seeker_org_id": "seeker_user_id", "seeker_org_name": "Organisation",
    "request_type": "request_type", "title": "title", "normalised_title": "normalised_title",
    "normalised_title_sector": "normalised_title_sector", "seeker_email": "seeker_email",
    "seeker_age": "seeker_age", "seeker_iti_specialization": "seeker_iti_specialization",
    "seeker_highest_qualification": "seeker_highest_qualification",
    "llm_location_district": "llm_location_district", "llm_location_state": "llm_location_state",
    "seeker_user_phone": "seeker_user_phone", "seeker_user_email": "seeker_user_email",
}


def renamed(df: DataFrame, key: str, key_as: str, cols: dict[str, str]) -> DataFrame:
    """state, the key and some columns under new names; missing columns are null."""
    picked = [
        (F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(a)
        for c, a in cols.items()
    ]
    order = [F.col(c).alias(f"_first_{c}") for c in FIRST_BY if c in df.columns]
    return df.select("state", F.col(key).alias(key_as), *picked, *order)


def lookup_table(df: DataFrame, key: str, key_as: str, cols: dict[str, str]) -> DataFrame:
    """Keep-first lookup: one row per (state, key), the first by created_at and id."""
    order = tuple(f"_first_{c}" for c in FIRST_BY)
    return first_per_key(renamed(df, key, key_as, cols), ["state", key_as], list(cols.values()), order)


def merge_lookups(parts: list[DataFrame], key: str) -> DataFrame:
    """Lookups on one key as one table: a union and a single aggregation.

    Every part holds a key at most once and columns of its own, so the first value that is
    not null is the one there is.
    """
    cols = [c for p in parts for c in p.columns if c not in ("state", key)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.filter(F.col(key).isNotNull()).groupBy("state", key).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in cols]
    )


def org_of_member(members: DataFrame, orgs: DataFrame) -> DataFrame:
    """First organisation of each seeker with its name: (state, user_id, org_id, org_name)."""
    names = lookup_table(orgs, "id", "organization_id", {"name": "org_name"})
    firsts = first_org_per_user(members.drop("side"))
    return skew_join(firsts, names, ["state", "organization_id"]).withColumnRenamed("organization_id", "org_id")


def job_lookup(jobs: DataFrame, orgs: DataFrame, users: DataFrame) -> DataFrame:
    """JN-11..JN-13: posting, its organisation's contact and its creator."""
    job = lookup_table(jobs, "id", "job_id", {
        "organization_name": "j_company", "organization_id": "j_org", "created_by": "j_user",
        "llm_location_state": "j_state", "llm_location_district": "j_district",
    })
    org = lookup_table(orgs, "id", "j_org", {
        "contact_person": "o_person", "contact_phone": "o_phone", "contact_email": "o_email",
    })
    user = lookup_table(users, "id", "j_user", {"phone_number": "p_phone", "email": "p_email"})
    return skew_join(skew_join(job, org, ["state", "j_org"]), user, ["state", "j_user"])


def applicant_lookup(users: DataFrame, profiles: DataFrame, members: DataFrame, orgs: DataFrame,
                     profile_key: str = "user_id") -> DataFrame:
    """JN-14..JN-16: everything that is looked up by an application's user_id."""
    user = lookup_table(users, "id", "user_id", {"phone_number": "s_phone", "email": "s_email"})
    profile = lookup_table(profiles, profile_key, "user_id", {
        "llm_location_district": "f_district", "llm_location_state": "f_state",
        "iti_institute": "f_institute",
    })
    bridge = lookup_table(profiles, "id", "_profile", {"user_id": "_uid"})
    member = org_of_member(members, orgs).withColumnRenamed("user_id", "_uid")
    org = skew_join(bridge.dropna(), member, ["state", "_uid"], "inner").select(
        "state", F.col("_profile").alias("user_id"), "org_id", "org_name"
    )
    return merge_lookups([user, profile, org], "user_id")


def application_fact(apps: DataFrame, jobs: DataFrame, org_provider: DataFrame,
                     user_provider: DataFrame, user_seeker: DataFrame, profiles: DataFrame,
                     members: DataFrame, org_seeker: DataFrame, profile_key: str = "user_id") -> DataFrame:
    """RUL-32: 41 columns per application, in every state."""
    job = job_lookup(jobs, org_provider, user_provider)
    person = applicant_lookup(user_seeker, profiles, members, org_seeker, profile_key)
    rows = skew_join(skew_join(apps, job, ["state", "job_id"]), person, ["state", "user_id"])

    def text(name: str) -> Column:
        return as_text(F.col(name)) if name in rows.columns else F.lit("")

    def day(name: str) -> Column:
        return fmt_date(timestamp_column(apps, name)) if name in apps.columns else F.lit("")

    out = {n: text(n) for n in (
        "id", "job_id", "transaction_id", "status", "application_status", "user_name",
        "user_id", "location", "contact", "metadata",
    )} | {
        "applied_at": day("applied_at"), "updated_at": day("updated_at"),
        "phone": text("seeker_phone"), "formatted_phone": display_phone(F.col("seeker_phone")),
        "company_name": text("j_company"), "location_copy": text("location"),
        "test_flag": to_num_text(F.col("test_flag")),
        "user_phone": text("p_phone"), "user_email": text("p_email"),
        "user_district": text("j_district"), "user_state": text("j_state"),
        "job_role": text("job_role"), "institution_name": text("f_institute"),
        "institution_id": F.lit(""), "contact_name": text("o_person"),
        "contact_number": text("o_phone"), "contact_email": text("o_email"),
        "seeker_org_id": text("org_id"), "seeker_org_name": text("org_name"),
        "request_type": F.lit(""), "title": text("job_title"),
        "normalised_title": text("llm_job_title_normalized"),
        "normalised_title_sector": text("llm_job_title_sector"),
        "seeker_email": text("seeker_email"), "seeker_age": text("seeker_age"),
        "seeker_iti_specialization": text("seeker_iti_specialization"),
        "seeker_highest_qualification": text("seeker_highest_qualification"),
        "llm_location_district": text("f_district"), "llm_location_state": text("f_state"),
        "seeker_user_phone": text("s_phone"), "seeker_user_email": text("s_email"),
    }
    return rows.select(F.col("state").alias("data_state"), *[e.alias(n) for n, e in out.items()])
