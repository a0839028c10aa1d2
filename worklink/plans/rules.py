"""Rule chains of the report tables (RUL-22..RUL-30)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from worklink.constants import (
    JOB_FOLLOW_UPS,
    PROVIDER_ACTIONS,
    REQUEST_TYPE,
    SEEKER_ACTION,
    SEEKER_FOLLOW_UPS,
)
from worklink.functions.text import as_text, labels, number


def _yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _empty(c: Column) -> Column:
    return as_text(c) == ""


def openings_number(positions: Column) -> Column:
    """Number of openings without its fraction, 0 when there is none."""
    return F.coalesce(number(positions).try_cast("bigint"), F.lit(0))


def job_status(job_age: Column, apps: Column, shortlisted: Column, rejected: Column,
               openings: Column, shortlisted_age: Column, rejected_age: Column) -> Column:
    """RUL-22: first rule that holds."""
    resolved = shortlisted + rejected
    resolved_age = F.least(shortlisted_age, rejected_age)  # skips nulls
    some_resolved = (apps > 0) & (resolved > 0)
    slow = some_resolved & resolved_age.between(31, 90) & (resolved < openings)
    waiting = (job_age > 7) & (job_age <= 30) & (apps == 0)
    return (
        F.when(job_age <= 7, "New")
        .when((apps > 0) & (resolved >= openings) & (openings > 0), "Satisfied")
        .when(some_resolved & (resolved_age <= 30), "Active")
        .when(_yes(slow) | _yes(waiting), "At Risk")
        .otherwise("Inactive")
    )


def seeker_status(profile_age: Column, last_applied_age: Column) -> Column:
    """RUL-23: a seeker without a creation date counts as new."""
    return (
        F.when(F.coalesce(profile_age, F.lit(0)) <= 7, "New")
        .when(last_applied_age <= 30, "Active")
        .when(last_applied_age <= 90, "At Risk")
        .otherwise("Inactive")
    )


def provider_action(apps: Column, shortlisted: Column, rejected: Column, job_age: Column) -> Column:
    """RUL-27."""
    undecided = (shortlisted == 0) & (rejected == 0)
    nudge, check = PROVIDER_ACTIONS
    return labels("; ", ((apps > 0) & undecided, nudge), ((job_age >= 30) & undecided, check))


def job_follow_up(org: Column, role: Column, positions: Column, salary: Column,
                  description: Column, contact: Column, email: Column, org_id: Column,
                  shortlisted: Column, rejected: Column,
                  texts: tuple[str, ...] = JOB_FOLLOW_UPS) -> Column:
    """RUL-28: the labels are a parameter, their default is the published wording."""
    openings = number(positions)
    over = (openings == F.floor(openings)) & (shortlisted > rejected + openings)
    conditions = (
        _empty(org) | _empty(role) | _empty(positions),
        _empty(salary),
        _empty(description),
        _empty(contact),
        _empty(email) | _empty(org_id) | _empty(org),
        _yes(over),
    )
    return labels(", ", *zip(conditions, texts))


def seeker_follow_up(user_id: Column, phone: Column, trade: Column, age: Column,
                     texts: tuple[str, ...] = SEEKER_FOLLOW_UPS) -> Column:
    """RUL-29: the location label is unconditional because no pincode is ever known."""
    conditions = (_empty(user_id), F.lit(True), _empty(phone) & _empty(trade), _empty(age))
    return labels(", ", *zip(conditions, texts))


def request_type(job_id: Column) -> Column:
    """RUL-30."""
    return F.when(_empty(job_id), "").otherwise(REQUEST_TYPE)


def seeker_action(profile_id: Column) -> Column:
    """RUL-30."""
    return F.when(_empty(profile_id), "").otherwise(SEEKER_ACTION)
