"""Scores and rule chains of matching (RUL-15..RUL-20, FN-36, AGG-15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from worklink.constants import (
    CONFIDENCE_LABELS,
    EDUCATION_LEVELS,
    LOCATION_FIT,
    LOWEST_LABEL,
    PARTIAL_FIT,
    RIGHT_FIT,
    ROLE_FIT,
    WEIGHTS,
)
from worklink.functions.text import split_parts, trimmed


def _none() -> Column:
    return F.lit(None).cast("double")


def edu_level(c: Column) -> Column:
    """FN-36: highest level among the parts of a '|' list, null when none is known.

    A part counts by its exact text, otherwise by the first ladder text it holds.
    """

    def level(part: Column) -> Column:
        exact = F.coalesce(*[F.when(part == k, F.lit(v)) for k, v in EDUCATION_LEVELS.items()])
        inside = F.coalesce(
            *[F.when(part.contains(k), F.lit(v)) for k, v in EDUCATION_LEVELS.items()]
        )
        return F.coalesce(exact, inside)

    return F.array_max(F.transform(split_parts(F.lower(c.cast("string"))), level))


def education_score(seeker_level: Column, job_level: Column) -> Column:
    """RUL-17: enough 1, one level short .5, more 0, unknown null."""
    diff = seeker_level - job_level
    return F.when(diff >= 0, 1.0).when(diff == -1, 0.5).when(diff < -1, 0.0)


def location_score(
    seeker_state: Column, job_state: Column, seeker_district: Column, job_district: Column
) -> Column:
    """RUL-15 on any text; see location_score_of for texts already folded."""
    fold = [F.lower(trimmed(c)) for c in (seeker_state, job_state, seeker_district, job_district)]
    return location_score_of(*fold)


def location_score_of(ss: Column, js: Column, sd: Column, jd: Column) -> Column:
    """RUL-15 on trimmed lower-case texts, '' for missing."""
    return (
        F.when((ss == "") | (js == ""), _none())
        .when(~(ss.contains(js) | js.contains(ss)), 0.0)
        .when((sd == "") | (jd == ""), 0.6)
        .when(sd.contains(jd) | jd.contains(sd), 1.0)
        .otherwise(0.6)
    )


def salary_range(low: Column, high: Column) -> dict[str, Column]:
    """Bounds and buffer of a job's salary; null when neither bound is known."""
    a = F.coalesce(low, high * 0.8)
    b = F.coalesce(high, low * 1.2)
    lo, hi = F.least(a, b), F.greatest(a, b)
    return {"lo": lo, "hi": hi, "buffer": F.greatest((hi - lo) * 0.2, F.lit(2000.0))}


def salary_score_of(expected: Column, lo: Column, hi: Column, buffer: Column) -> Column:
    """RUL-16 on a prepared range: inside 1, within the buffer .5, outside 0."""
    return (
        F.when(expected.isNull() | lo.isNull(), _none())
        .when(expected.between(lo, hi), 1.0)
        .when(expected.between(lo - buffer, hi + buffer), 0.5)
        .otherwise(0.0)
    )


def salary_score(expected: Column, low: Column, high: Column) -> Column:
    """RUL-16 on numbers."""
    return salary_score_of(expected, **salary_range(low, high))


def weighted_mean(scores: list[Column], weights: list[float]) -> Column:
    """AGG-15: mean over the scores that are available, 0 when none is."""
    got = [(F.coalesce(s * w, F.lit(0.0)), F.when(s.isNotNull(), w).otherwise(0.0))
           for s, w in zip(scores, weights)]
    top = sum((t for t, _ in got[1:]), got[0][0])
    total = sum((w for _, w in got[1:]), got[0][1])
    return F.when(total > 0, top / total).otherwise(0.0)


def confidence(role: Column, location: Column, salary: Column, education: Column) -> Column:
    """RUL-18."""
    return weighted_mean([role, location, salary, education], list(WEIGHTS.values()))


def confidence_label(score: Column) -> Column:
    """RUL-19."""
    (first, text), *rest = CONFIDENCE_LABELS
    chain = F.when(score >= first, text)
    for floor, text in rest:
        chain = chain.when(score >= floor, text)
    return chain.otherwise(LOWEST_LABEL)


def fit_category(role: Column, location: Column) -> Column:
    """RUL-20: null unless the role fits; a location that is not available does not fit."""
    fits = F.coalesce(location >= LOCATION_FIT, F.lit(False))
    return F.when((role >= ROLE_FIT) & fits, RIGHT_FIT).when(role >= ROLE_FIT, PARTIAL_FIT)
