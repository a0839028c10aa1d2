"""Job report: one row per open posting (RUL-31, JN-08..JN-10, PRJ-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklink.functions.text import (
    age_days,
    as_text,
    completion,
    display_phone,
    fmt_date,
    fmt_salary,
    to_num_text,
)
from worklink.operators.keyed import first_per_key, mark_duplicates, skew_join
from worklink.operators.matching import open_jobs
from worklink.operators.stats import application_stats, as_of_date, timestamp_column
from worklink.plans import rules

# fixed values: report column -> header of the published table
HEADERS = {
    "id": "id", "location": "location", "organization_name": "organization_name",
    "role": "Role", "openings": "Openings", "salary": "Salary",
    "job_description": "Job Description",
    "contact_name": "Contact Name of created_by id",
    "contact_number": "Contact Number of created_by id",
    "contact_email": "Contact email ID", "organisation_id": "organisation id",
    "organisation_name": "organisation name", "job_post_date": "Job Post Date",
    "applications": "Applications", "shortlisted": "Shortlisted", "rejected": "Rejected",
    "current_openings": "Current Openings (", "duplicate": "Duplicate",
    "job_sector": "Job Sector", "job_age": "Job Age",
    "right_fit_seekers": "Right Fit Seekers Count",
    "last_application_date": "Last Application Date",
    "application_pending_from": "Application Pending From",
    "shortlisted_age": "Shortlisted Age", "rejected_age": "Rejected Age",
    "provider_action": "Recommended Action for Job Provider",
    "seeker_action": "Recommended Action for Job Seeker",
    "request_type": "Request_type", "profile_completion": "Profile Completion",
    "follow_up": "Follow up for", "status": "Status", "normalised_role": "normalised_role",
    "location_state": "location_state", "location_district": "location_district",
    "test": "test", "partial_fit_seekers": "Partial Fit Seeker Count", "title": "title",
    "normalised_title": "normalised_title",
    "normalised_title_sector": "normalised_title_sector",
}


def with_contacts(jobs: DataFrame, users: DataFrame) -> DataFrame:
    """JN-08: name, phone and e-mail of the user who created the posting."""
    named = {"created_by": "id", "u_name": "name", "u_phone": "phone_number", "u_email": "email"}
    contacts = first_per_key(
        users.withColumns({a: F.col(c) for a, c in named.items()}), ["state", "created_by"], ["u_name", "u_phone", "u_email"])
    return skew_join(jobs, contacts, ["state", "created_by"])


def posting_salary():
    return fmt_salary(F.col("min_monthly_in_hand"), F.col("max_monthly_in_hand"))


def duplicate_key() -> dict:
    """RUL-24: the seven fields of a repeated posting; the phone as it was typed."""
    names = ["organization_name", "role", "positions", "salary", "job_description",
             "u_name", "u_phone"]
    return {n: F.col(n) for n in names}


def with_job_facts(jobs: DataFrame, users: DataFrame, apps: DataFrame, as_of=None) -> DataFrame:
    """Open postings with contact, application statistics, ages and the duplicate mark."""
    day = as_of_date(as_of)
    rows = with_contacts(open_jobs(jobs, include_flagged=True), users)
    rows = rows.withColumn("salary", posting_salary())
    rows = mark_duplicates(rows, duplicate_key(), keep=["state"])
    stats = application_stats(apps.withColumnRenamed("job_id", "_job"), "_job", day)
    rows = rows.join(
        stats.withColumnRenamed("state", "_state"),
        (F.col("state") == F.col("_state")) & (F.col("id") == F.col("_job")), "left",
    ).drop("_state", "_job")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("applications", "shortlisted", "rejected")}
    return rows.withColumns(
        counts | {"_created": timestamp_column(jobs, "created_at")}
    ).withColumn("job_age", age_days(F.col("_created"), day))


def open_roles(jobs: DataFrame, users: DataFrame, apps: DataFrame, fit: DataFrame | None = None,
               as_of=None) -> DataFrame:
    """RUL-31. `fit` holds (state, provider_job_id, right_fit, partial_fit)."""
    rows = with_job_facts(jobs, users, apps, as_of)
    if fit is None:
        rows = rows.withColumns({"right_fit": F.lit(0), "partial_fit": F.lit(0)})
    else:
        fit = fit.select(F.col("state").alias("_state"), "provider_job_id", "right_fit", "partial_fit")
        rows = rows.join(
            fit, (F.col("state") == F.col("_state")) & (F.col("id") == F.col("provider_job_id")),
            "left",
        )
    c = F.col
    has = rows.columns

    def text(name: str):
        return as_text(c(name)) if name in has else F.lit("")

    openings = to_num_text(c("positions"))
    out = {
        "id": text("id"), "location": text("location"),
        "organization_name": text("organization_name"), "role": text("role"),
        "openings": openings, "salary": c("salary"),
        "job_description": text("job_description"), "contact_name": text("u_name"),
        "contact_number": display_phone(c("u_phone")), "contact_email": text("u_email"),
        "organisation_id": text("organization_id"),
        "organisation_name": text("organization_name"),
        "job_post_date": fmt_date(c("_created")), "applications": c("applications"),
        "shortlisted": c("shortlisted"), "rejected": c("rejected"),
        "current_openings": openings, "duplicate": c("duplicate"),
        "job_sector": text("llm_role_sector"), "job_age": c("job_age"),
        "right_fit_seekers": F.coalesce(c("right_fit").cast("long"), F.lit(0)),
        "last_application_date": fmt_date(c("last_applied")),
        "application_pending_from": c("application_pending_from"),
        "shortlisted_age": c("shortlisted_age"), "rejected_age": c("rejected_age"),
        "provider_action": rules.provider_action(
            c("applications"), c("shortlisted"), c("rejected"), c("job_age")),
        "seeker_action": F.lit(""), "request_type": rules.request_type(c("id")),
        "profile_completion": job_completion(),
        "follow_up": rules.job_follow_up(
            c("organization_name"), c("role"), c("positions"), c("salary"), c("job_description"),
            c("u_name"), c("u_email"), c("organization_id"), c("shortlisted"), c("rejected")),
        "status": status(), "normalised_role": text("llm_role_normalized"),
        "location_state": text("llm_location_state"),
        "location_district": text("llm_location_district"),
        "test": to_num_text(c("test_flag")),
        "partial_fit_seekers": F.coalesce(c("partial_fit").cast("long"), F.lit(0)),
        "title": text("title"), "normalised_title": text("llm_title_normalized"),
        "normalised_title_sector": text("llm_title_sector"),
    }
    return rows.select("state", *[e.alias(n) for n, e in out.items()])


def job_completion():
    """RUL-25: eight fields."""
    c = F.col
    return completion([
        c("organization_name"), c("role"), c("positions"), c("salary"), c("job_description"),
        c("u_name"), display_phone(c("u_phone")), c("u_email"),
    ])


def status():
    c = F.col
    return rules.job_status(
        c("job_age"), c("applications"), c("shortlisted"), c("rejected"),
        rules.openings_number(c("positions")), c("shortlisted_age"), c("rejected_age"),
    )
