"""Seeker report: one row per profile (RUL-33, JN-17..JN-20, PRJ-15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklink.functions import variant as V
from worklink.functions.text import age_days, as_text, completion, fmt_date, phone_key, to_num_text
from worklink.operators.keyed import skew_join
from worklink.operators.stats import application_stats, as_of_date, timestamp_column
from worklink.plans import rules
from worklink.plans.application_fact import lookup_table, merge_lookups, org_of_member

# fixed values: report column -> header of the published table
HEADERS = {
    "id": "id", "user_id": "user_id", "name": "name", "location": "location",
    "longitude": "longitude", "latitude": "latitude", "location_district": "location_district ",
    "location_state": "location_state", "pincode": "pincode", "email": "email id",
    "phone": "Phone Number", "trade": "trade", "institution_name": "institution name",
    "role": "Role", "test": "test", "age": "Age", "expected_salary": "Expected Salary",
    "qualification": "Qualification", "org_id": "Org id", "org_name": "Org Name",
    "recommended_action": "Recommended Action", "applications": "Applications",
    "shortlisted": "Shortlisted", "rejected": "Rejected",
    "profile_completion": "Profile Completion", "follow_up": "Follow up for",
    "created_on": "Created_On", "profile_age": "Profile Age",
    "last_applied_age": "Last Applied Age", "last_application_date": "Last Application Date",
    "status": "Status", "partial_fit": "Partial Fit", "direct_fit": "Direct Fit",
    "normalised_role": "normalised_role", "job_sector": "Job Sector",
}


def gps(meta: Column) -> tuple[Column, Column]:
    """FN-24: latitude and longitude of a parsed seeker document, '' when absent."""
    point = "$.whoIAm.locationData.gps."
    lat, lng = [to_num_text(F.try_variant_get(meta, point + k, "string")) for k in ("lat", "lng")]
    return lat, lng


def phone_stats(apps: DataFrame, as_of: Column) -> DataFrame:
    """AGG-06: statistics per phone; the phone is the only key both sides share."""
    keyed = apps.withColumn("phone_key", phone_key(F.col("seeker_phone")))
    return application_stats(keyed, "phone_key", as_of).drop(
        "application_pending_from", "shortlisted_age", "rejected_age"
    )


def seeker_completion() -> Column:
    """RUL-26: thirteen slots; the slot of the pincode is always empty."""
    c = F.col
    fields = [
        c("name"), c("current_location"), c("llm_location_district"), c("llm_location_state"),
        c("email"), c("phone"), c("iti_specialization"), c("iti_institute"), c("role"),
        to_num_text(c("age")), to_num_text(c("monthly_in_hand_preferred")),
        c("highest_qualification"),
    ]
    return completion(fields, slots=13)


def with_seeker_facts(profiles: DataFrame, apps: DataFrame, as_of=None) -> DataFrame:
    """JN-19: profiles with the statistics of their phone and their ages."""
    day = as_of_date(as_of)
    keyed = profiles.withColumn("phone_key", phone_key(F.col("phone")))
    rows = skew_join(keyed, phone_stats(apps, day), ["state", "phone_key"])
    created = timestamp_column(profiles, "created_at")
    return rows.withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("applications", "shortlisted", "rejected")}
        | {"_created": created}
    ).withColumn("profile_age", F.coalesce(age_days(F.col("_created"), day), F.lit(0)))


def seeker_profile(profiles: DataFrame, user_seeker: DataFrame, members: DataFrame,
                   org_seeker: DataFrame, apps: DataFrame, fit: DataFrame | None = None,
                   as_of=None) -> DataFrame:
    """RUL-33. `fit` holds (state, seeker_id, right_fit, partial_fit)."""
    parts = [
        lookup_table(user_seeker, "id", "user_id", {"email": "email"}),
        org_of_member(members, org_seeker),
    ]
    if fit is not None:
        parts.append(fit.withColumnRenamed("seeker_id", "user_id"))
    person = merge_lookups(parts, "user_id")
    wanted = profiles.drop("email", "org_id", "org_name", "right_fit", "partial_fit")
    if "metadata" in profiles.columns:
        wanted = wanted.withColumn("_meta", V.parse_obj(F.col("metadata")))
        wanted = wanted.withColumns(dict(zip(("_lat", "_lng"), gps(F.col("_meta"))))).drop("_meta")
    else:
        wanted = wanted.withColumns({"_lat": F.lit(""), "_lng": F.lit("")})
    rows = with_seeker_facts(skew_join(wanted, person, ["state", "user_id"]), apps, as_of)
    c = F.col

    def text(name: str) -> Column:
        return as_text(c(name)) if name in rows.columns else F.lit("")

    def fits(name: str) -> Column:
        return F.coalesce(c(name).cast("long"), F.lit(0)) if fit is not None else F.lit(0).cast("long")

    age, salary = to_num_text(c("age")), to_num_text(c("monthly_in_hand_preferred"))
    out = {
        "id": text("id"), "user_id": text("user_id"), "name": text("name"),
        "location": text("current_location"), "longitude": c("_lng"), "latitude": c("_lat"),
        "location_district": text("llm_location_district"),
        "location_state": text("llm_location_state"), "pincode": F.lit(""),
        "email": text("email"), "phone": text("phone"), "trade": text("iti_specialization"),
        "institution_name": text("iti_institute"), "role": text("role"),
        "test": to_num_text(c("test_flag")), "age": age, "expected_salary": salary,
        "qualification": text("highest_qualification"), "org_id": text("org_id"),
        "org_name": text("org_name"), "recommended_action": rules.seeker_action(c("id")),
        "applications": c("applications"), "shortlisted": c("shortlisted"),
        "rejected": c("rejected"), "profile_completion": seeker_completion(),
        "follow_up": rules.seeker_follow_up(
            c("user_id"), c("phone"), c("iti_specialization"), age),
        "created_on": fmt_date(c("_created")), "profile_age": c("profile_age"),
        "last_applied_age": c("last_applied_age"),
        "last_application_date": fmt_date(c("last_applied")),
        "status": rules.seeker_status(c("profile_age"), c("last_applied_age")),
        "partial_fit": fits("partial_fit"), "direct_fit": fits("right_fit"),
        "normalised_role": text("llm_role_normalized"), "job_sector": text("llm_role_sector"),
    }
    return rows.select("state", *[e.alias(n) for n, e in out.items()])
