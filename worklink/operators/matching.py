"""Seeker-to-job matching (FLT-01..FLT-07, RUL-13, RUL-14, RUL-21, JN-01..JN-07, AGG-01, AGG-02).

Scores depend on a few columns of a seeker and a few of a job. Rows that agree
on them are collapsed into one signature with a row count; signatures are
scored against each other; counts of fits come straight from the signature
sizes, and rows are expanded again only for the pairs that are reported, in the
task that scores them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklink.constants import (
    CONFIDENCE_FLOOR,
    PARTIAL_FIT,
    RIGHT_FIT,
    ROLE_FIT,
    ROLE_PAIR_FLOOR,
)
from worklink.functions import scores as S
from worklink.functions.text import (
    clean_str,
    first_non_blank,
    number,
    percent,
    percent_even,
    percent_text,
    split_parts,
    trimmed,
)
from worklink.operators.keyed import (
    first_org_per_user,
    first_per_key,
    key_rows,
    product_join,
    ranked,
    result_sizes,
    skew_join,
)
from worklink.operators.similarity import scored_pairs
from worklink.session import stage

SEEKER_SIGNATURE = ["state", "sk_key", "sk_state", "sk_district", "sk_salary", "sk_level"]
JOB_SIGNATURE = ["state", "pr_role", "pr_state", "pr_district", "pr_min", "pr_max", "pr_level"]
PACK_ROWS = 64  # rows of a signature that travel together


def only_states(df: DataFrame, states: Sequence[str] | None) -> DataFrame:
    """FLT-08: a filter on the partition column."""
    return df.filter(F.col("state").isin(*states)) if states else df


def genuine(df: DataFrame) -> DataFrame:
    """FLT-02: rows that are not flagged; a flag that is missing or no number does not count as one."""
    return df.filter(F.coalesce(number(F.col("test_flag")), F.lit(0.0)) == 0)


def genuine_seekers(df: DataFrame) -> DataFrame:
    """FLT-03: seekers whose flag is missing or zero; any other text drops the seeker."""
    flag = trimmed(F.col("test_flag").cast("string"))
    return df.filter((F.coalesce(flag, F.lit("")) == "") | (number(flag) == 0))


def open_jobs(jobs: DataFrame, include_flagged: bool = False) -> DataFrame:
    """FLT-01, FLT-02."""
    kept = jobs.filter(F.lower(trimmed(F.col("status"))) == "open")
    return kept if include_flagged else genuine(kept)


def _present(df: DataFrame, *names: str) -> list[Column]:
    return [F.col(c) if c in df.columns else F.lit(None).cast("string") for c in names]


def seeker_trade_key(df: DataFrame) -> Column:
    """PRJ-16."""
    return first_non_blank(*_present(df, "iti_specialization", "role"))


def job_role_key(df: DataFrame) -> Column:
    """PRJ-17."""
    return first_non_blank(*_present(
        df, "llm_title_normalized", "llm_job_title_normalized", "job_title", "title", "role"
    ))


def _fold(c: Column) -> Column:
    return F.lower(trimmed(c))


def _number_text(c: Column) -> Column:
    """A number as an equality key; '' where there is none."""
    return F.coalesce(number(c).cast("string"), F.lit(""))


def keyed_seekers(seekers: DataFrame) -> DataFrame:
    """Genuine seekers that have a trade, with the columns scoring reads."""
    return genuine_seekers(seekers).withColumns({
        "sk_key": seeker_trade_key(seekers),
        "sk_state": _fold(F.col("llm_location_state")),
        "sk_district": _fold(F.col("llm_location_district")),
        "sk_salary": _number_text(F.col("monthly_in_hand_preferred")),
        "sk_level": F.coalesce(S.edu_level(F.col("highest_qualification")), F.lit(0)),
    }).filter(F.col("sk_key").isNotNull())


def keyed_jobs(jobs: DataFrame) -> DataFrame:
    """Open genuine jobs that have a role, with the columns scoring reads."""
    return open_jobs(jobs).withColumns({
        "pr_role": job_role_key(jobs),
        "pr_state": _fold(F.col("llm_location_state")),
        "pr_district": _fold(F.col("llm_location_district")),
        "pr_min": _number_text(F.col("min_monthly_in_hand")),
        "pr_max": _number_text(F.col("max_monthly_in_hand")),
        "pr_level": F.coalesce(S.edu_level(F.col("min_education_level")), F.lit(0)),
    }).filter(F.col("pr_role").isNotNull())


def role_pairs(seekers: DataFrame, jobs: DataFrame, floor: float = ROLE_PAIR_FLOOR) -> DataFrame:
    """RUL-13, RUL-14: (sk_key, pr_role, role_score, best_trade) with role_score >= floor.

    Works on distinct texts: `sk_key` of the seekers, `pr_role` of the jobs. A
    trade list scores as its best trade, the first one on ties.
    """
    keys = stage(seekers.select("sk_key").distinct())
    trades = keys.select("sk_key", F.posexplode(split_parts(F.col("sk_key"))).alias("pos", "value"))
    roles = jobs.select(F.col("pr_role").alias("value")).distinct()
    scored = scored_pairs(trades.select("value").distinct(), roles, floor)
    best = F.max_by(
        F.struct("score", "value"), F.struct(F.col("score"), -F.col("pos"))
    ).alias("best")
    return (
        scored.select(F.col("left_value").alias("value"), F.col("right_value").alias("pr_role"), "score")
        .join(trades, "value")
        .groupBy("sk_key", "pr_role")
        .agg(best)
        .select("sk_key", "pr_role", F.round("best.score", 4).alias("role_score"),
                F.col("best.value").alias("best_trade"))
    )


def _signatures(df: DataFrame, cols: list[str], size: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(size))


def _bound(c: str) -> Column:
    return F.col(c).try_cast("double")


def _level(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(0))


def _sides(seekers: DataFrame, jobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signatures of both sides with the numbers that scoring reads.

    Signatures are few and read several times: they are kept in the checkpoint
    folder, so the tables below are scanned and their keys derived only once.
    Numbers are read once per signature, before the pairs are formed.
    """
    sk = stage(_signatures(seekers, SEEKER_SIGNATURE, "n_seekers")).withColumn("wanted", _bound("sk_salary"))
    pr = stage(_signatures(jobs, JOB_SIGNATURE, "n_jobs")).withColumns(S.salary_range(_bound("pr_min"), _bound("pr_max")))
    return sk, pr


def _fitting_pairs(sk: DataFrame, pr: DataFrame, pairs: DataFrame | None) -> DataFrame:
    """Role pairs that can get a category, stored."""
    if pairs is None:
        # candidates one rounding step below the threshold; the rounded score decides
        pairs = role_pairs(sk, pr, ROLE_FIT - 0.0001)
    return stage(pairs.filter(F.col("role_score") >= ROLE_FIT))


def scored_signatures(seekers: DataFrame, jobs: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Signature pairs that reach the confidence floor and have a fit category.

    Only role scores of at least ROLE_FIT can get a category, so the pair table
    is built with that floor (on the rounded score) to begin with.
    """
    sk, pr = _sides(seekers, jobs)
    return _scored(sk, pr, _fitting_pairs(sk, pr, pairs), F.lit(1), F.lit(1), SEEKER_SIGNATURE)


def _scored(sk: DataFrame, pr: DataFrame, pairs: DataFrame, sk_rows: Column, pr_rows: Column, spread: list[str]) -> DataFrame:
    """Rows of both sides whose roles fit, scored; a row stands for as many as `sk_rows` and `pr_rows` say.

    What a popular role gives is cut into pieces: the seekers' rows, which come once for each role they fit, are dealt to
    them by the `spread` columns, the jobs, which are fewer, go to all.
    """
    # a popular trade and a popular role both multiply: each is cut into pieces by its result, counted in one pass
    trades = sk.groupBy("state", "sk_key").agg(F.count(F.lit(1)).alias("_n"), F.sum(sk_rows).alias("_rows"))
    wanted = pairs.join(trades, "sk_key").select("state", "pr_role", "_rows")
    sizes = result_sizes({
        "trade": (key_rows(trades, ["sk_key"], F.col("_n")), key_rows(pairs, ["sk_key"])),
        "role": (key_rows(pr, ["state", "pr_role"], pr_rows), key_rows(wanted, ["state", "pr_role"], F.col("_rows")))})
    with_roles = product_join(sk, pairs, ["sk_key"], spread, sizes=sizes["trade"])
    joined = product_join(with_roles, pr, ["state", "pr_role"], spread, sizes=sizes["role"])
    # as generators, so that a score is computed once: filters would be pushed into the join with copies of all of them
    parts = F.struct(
        S.location_score_of(F.col("sk_state"), F.col("pr_state"), F.col("sk_district"), F.col("pr_district")).alias("location_score"),
        S.salary_score_of(F.col("wanted"), F.col("lo"), F.col("hi"), F.col("buffer")).alias("salary_score"),
        S.education_score(_level("sk_level"), _level("pr_level")).alias("education_score"))
    reached = S.confidence(F.col("role_score"), F.col("location_score"), F.col("salary_score"), F.col("education_score"))
    fits = F.struct(reached.alias("confidence"), S.fit_category(F.col("role_score"), F.col("location_score")).alias("match_category"))
    scored = joined.select("*", F.inline(F.array(parts))).drop("wanted", "lo", "hi", "buffer").select("*", F.inline(F.array(fits)))
    return scored.filter((F.col("confidence") >= CONFIDENCE_FLOOR) & F.col("match_category").isNotNull())


SCORES = ["role_score", "best_trade", "location_score", "salary_score", "education_score",
          "confidence", "match_category"]


def expand(signatures: DataFrame, seekers: DataFrame, jobs: DataFrame) -> DataFrame:
    """JN-02, JN-03: scored signature pairs back to rows of seekers and jobs.

    `seekers` and `jobs` hold their signature columns plus whatever is to be
    carried along. Both joins cut a signature into pieces by the size of its result, which the signatures' own
    numbers of rows give.
    """
    jobs_of = signatures.groupBy(*JOB_SIGNATURE).agg(F.max("n_jobs").alias("_rows"), F.count(F.lit(1)).alias("_met"))
    seekers_of = signatures.groupBy(*SEEKER_SIGNATURE).agg(F.max("n_seekers").alias("_rows"), F.sum("n_jobs").alias("_met"))
    sizes = result_sizes({name: tuple(key_rows(df, on, F.col(c)) for c in ("_rows", "_met"))
                          for name, df, on in (("job", jobs_of, JOB_SIGNATURE), ("seeker", seekers_of, SEEKER_SIGNATURE))})
    scored = signatures.select(*SEEKER_SIGNATURE, *[c for c in JOB_SIGNATURE if c != "state"], *SCORES)
    per_job = product_join(jobs, scored, JOB_SIGNATURE, ["provider_job_id"], sizes=sizes["job"])
    per_job = per_job.drop("pr_state", "pr_district", "pr_min", "pr_max", "pr_level")
    joined = product_join(seekers, per_job, SEEKER_SIGNATURE, ["seeker_row", "seeker_id"], sizes=sizes["seeker"])
    return joined.drop("sk_state", "sk_district", "sk_salary", "sk_level", "seeker_row")


def _packed(rows: DataFrame, signature: list[str], name: str) -> DataFrame:
    """Rows by signature, at most PACK_ROWS of one together as an array of what they carry; a signature may have many packs.

    Sorted ranges number the rows, so that a signature with most of the rows is no task's alone.
    """
    carried = F.struct(*[c for c in rows.columns if c not in signature]).alias("_row")
    dealt = rows.select(*signature, carried).withColumn("_h", F.xxhash64("_row"))
    dealt = dealt.repartitionByRange(*signature, "_h").sortWithinPartitions(*signature, "_h").drop("_h")
    numbered = stage(dealt.withColumn("_at", F.monotonically_increasing_id()))
    packs = numbered.groupBy(*signature, F.floor(F.col("_at") / PACK_ROWS).alias(f"_pack_{name}"))
    return stage(packs.agg(F.collect_list("_row").alias(name)))


def matched(seekers: DataFrame, jobs: DataFrame) -> DataFrame:
    """JN-02, JN-03: state, scores and what both rows carry, of every reported pair of a seeker and a job.

    `seekers` and `jobs` hold their signature columns plus whatever is to be carried along. Signatures come with
    their rows in packs, so a scored pair is expanded where it was scored: what is shuffled is the seekers' packs, once for
    every role that fits their trade, and the jobs' packs, but no pair.
    """
    sk = _packed(seekers, SEEKER_SIGNATURE, "seekers").withColumn("wanted", _bound("sk_salary"))
    pr = _packed(jobs, JOB_SIGNATURE, "jobs").withColumns(S.salary_range(_bound("pr_min"), _bound("pr_max")))
    scored = _scored(sk, pr, _fitting_pairs(sk, pr, None), F.size("seekers"), F.size("jobs"), [*SEEKER_SIGNATURE, "_pack_seekers"])
    some = scored.select("state", *SCORES, "jobs", F.explode("seekers").alias("_seeker"))
    return some.select("state", *SCORES, "_seeker", F.explode("jobs").alias("_job")).select("state", *SCORES, "_seeker.*", "_job.*")


def match(seekers: DataFrame, jobs: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    """RUL-21: ids and scores of every reported pair."""
    sk, pr = keyed_seekers(only_states(seekers, states)), keyed_jobs(only_states(jobs, states))
    return matched(
        sk.select(*SEEKER_SIGNATURE, trimmed(F.col("user_id")).alias("seeker_id")),
        pr.select(*JOB_SIGNATURE, trimmed(F.col("id")).alias("provider_job_id")),
    ).select("state", "seeker_id", "provider_job_id", *SCORES)


PLACE_SCORES, PART_SCORES = (None, 0.0, 0.6, 1.0), (None, 0.0, 0.5, 1.0)
MISSING, APART = 0, 1  # their places in PLACE_SCORES
MEETING = {"right_fit": "right_bits", "partial_fit": "partial_bits"}


def _code(score: Column, values: tuple) -> Column:
    """A score's place among the values it can have."""
    return F.coalesce(*[F.when(score == v, F.lit(i)) for i, v in enumerate(values) if v is not None], F.lit(0))


def _score(code: Column, values: tuple) -> Column:
    return F.get(F.array(*[F.lit(v).cast("double") for v in values]), code)


def fit_bits(pairs: DataFrame) -> DataFrame:
    """Per role score, which codes of the other scores are a right fit and which a partial one.

    Bit 16 * location + 4 * salary + education of a mask stands for one combination of codes.
    """
    code = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("code")
    rows = pairs.select("role_score").distinct().select("role_score", code)
    location = _score(F.floor(F.col("code") / 16).cast("int"), PLACE_SCORES)
    salary = _score(F.floor(F.col("code") / 4).cast("int") % 4, PART_SCORES)
    education = _score(F.col("code") % 4, PART_SCORES)
    reached = S.confidence(F.col("role_score"), location, salary, education) >= CONFIDENCE_FLOOR
    category = S.fit_category(F.col("role_score"), location)

    def bits(wanted: str) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("code"))
        return F.bit_or(F.when(reached & (category == wanted), bit).otherwise(F.lit(0).cast("long")))

    return rows.groupBy("role_score").agg(bits(RIGHT_FIT).alias("right_bits"), bits(PARTIAL_FIT).alias("partial_bits"))


def _spots(sk: DataFrame, pr: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Location scores as a sum over spots: (sk_state, sk_district, spot, plus, minus) and (pr_state, pr_district, spot, base).

    All places meet in one spot, where the score is the job's `base`: 0, or missing where its state is. Places whose states
    alone give another score meet in a spot of the job's state, those whose districts raise it in one of the job's place.
    There `plus` is the score and `minus` the one counted before, which is taken off. So a seeker's place lies in
    as many spots as it is related to, not in one for every job's place.
    """
    places = sk.select("sk_state", "sk_district").distinct()
    others = pr.select("pr_state", "pr_district").distinct()
    none = F.lit("")
    by_state = _code(S.location_score_of(F.col("sk_state"), F.col("pr_state"), none, none), PLACE_SCORES)
    states = places.select("sk_state").distinct().crossJoin(others.filter("pr_state <> ''").select("pr_state").distinct())
    states = stage(states.withColumn("plus", by_state).filter(F.col("plus") != APART))
    by_place = _code(S.location_score_of(F.col("sk_state"), F.col("pr_state"), F.col("sk_district"), F.col("pr_district")), PLACE_SCORES)
    near = places.join(states.withColumnRenamed("plus", "minus"), "sk_state").join(others, "pr_state")
    near = near.withColumn("plus", by_place).filter(F.col("plus") != F.col("minus"))
    unset = F.lit(None).cast("int")
    rows = stage(
        places.select("*", F.lit(0).alias("layer"), none.alias("a"), none.alias("b"), unset.alias("plus"), unset.alias("minus"))
        .unionByName(places.join(states, "sk_state").select(
            "sk_state", "sk_district", F.lit(1).alias("layer"), F.col("pr_state").alias("a"), none.alias("b"), "plus", F.lit(APART).alias("minus")))
        .unionByName(near.select(
            "sk_state", "sk_district", F.lit(2).alias("layer"), F.col("pr_state").alias("a"), F.col("pr_district").alias("b"), "plus", "minus")))
    key = ["layer", "a", "b"]
    ids = stage(rows.select(*key).distinct().withColumn("spot", F.monotonically_increasing_id()))
    own = F.array(*[F.struct(F.lit(n).alias("layer"), x.alias("a"), y.alias("b"))
                    for n, x, y in ((0, none, none), (1, F.col("pr_state"), none), (2, F.col("pr_state"), F.col("pr_district")))])
    base = F.when(F.col("pr_state") == "", MISSING).otherwise(APART).alias("base")
    return (stage(rows.join(ids, key).drop(*key)),
            stage(others.select("*", base, F.inline(own)).join(ids, key).drop(*key)))


def fit_sums(seekers: DataFrame, jobs: DataFrame, by: str = "job", pairs: DataFrame | None = None) -> DataFrame:
    """Right and partial fits per signature of jobs or of seekers, without forming the pairs of signatures.

    Seekers are added up per role they fit, bits of `fit_bits`, spot, salary and level; jobs per role, spot, salary
    range and level. Only these sums meet, so the work grows with the rows times the roles of a trade and
    with the kinds of salaries and levels, not with the product of the two tables. Exact: all sums are of whole numbers.
    """
    sk, pr = _sides(seekers, jobs)
    pairs = _fitting_pairs(sk, pr, pairs)
    roles = stage(pr.select("state", "pr_role").distinct().withColumn("role", F.monotonically_increasing_id()))
    fits = stage(pairs.join(fit_bits(pairs), "role_score").join(roles, "pr_role")
                 .select("state", "sk_key", "role", *MEETING.values()))
    sk_spots, pr_spots = _spots(sk, pr)
    kinds = ["spot", "plus", "minus", "sk_salary", "wanted", "sk_level"]
    trades = stage(sk.join(sk_spots, ["sk_state", "sk_district"]).groupBy("state", "sk_key", *kinds)
                   .agg(F.sum("n_seekers").alias("n_seekers")))
    cell = ["role", *MEETING.values(), *kinds]
    sizes = result_sizes({"trade": (key_rows(trades, ["state", "sk_key"]), key_rows(fits, ["state", "sk_key"]))})
    wide = product_join(trades, fits, ["state", "sk_key"], kinds, sizes=sizes["trade"])
    cells = stage(wide.groupBy(*cell).agg(F.sum("n_seekers").alias("n_seekers")))
    terms = ["role", "spot", "base", "pr_min", "pr_max", "lo", "hi", "buffer", "pr_level"]
    own_spots = pr.join(roles, ["state", "pr_role"]).join(pr_spots, ["pr_state", "pr_district"])
    offers = stage(own_spots.groupBy(*terms).agg(F.sum("n_jobs").alias("n_jobs")))
    met = product_join(cells, offers, ["role", "spot"], ["sk_salary", "sk_level", *MEETING.values()])
    salary = S.salary_score_of(F.col("wanted"), F.col("lo"), F.col("hi"), F.col("buffer"))
    education = S.education_score(_level("sk_level"), _level("pr_level"))
    # as a generator, so that a code is computed once
    met = met.select("*", F.inline(F.array(F.struct(
        (4 * _code(salary, PART_SCORES) + _code(education, PART_SCORES)).alias("part"), F.coalesce("plus", "base").alias("here")))))
    number = "n_seekers" if by == "job" else "n_jobs"

    def bit(mask: str, place: Column) -> Column:
        at = F.call_function("shiftrightunsigned", F.col(mask), 16 * place + F.col("part"))
        return at.bitwiseAND(F.lit(1).cast("long"))

    def total(mask: str) -> Column:
        taken = F.when(F.col("minus").isNull(), F.lit(0).cast("long")).otherwise(bit(mask, F.col("minus")))
        return F.sum(F.col(number) * (bit(mask, F.col("here")) - taken))

    sums = {name: total(mask).alias(name) for name, mask in MEETING.items()}
    again = [F.sum(c).alias(c) for c in MEETING]
    if by == "job":
        key = ["role", "spot", "base", "pr_min", "pr_max", "pr_level"]
        out = own_spots.select(*JOB_SIGNATURE, "role", "spot", "base").join(met.groupBy(*key).agg(*sums.values()), key)
        return out.groupBy(*JOB_SIGNATURE).agg(*again).filter("right_fit + partial_fit > 0")
    # a cell's sum goes back to the trades it was added up from, then to the signatures
    key = [c for c in cell if c != "wanted"]
    found = met.groupBy(*key).agg(*sums.values())
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) if c in ("plus", "minus") else F.col(f"l.{c}") == F.col(f"r.{c}") for c in key]
    back = wide.drop("wanted", "n_seekers").alias("l").join(found.alias("r"), same).select(
        "l.state", "l.sk_key", *[F.col(f"l.{c}").alias(c) for c in kinds if c != "wanted"], *MEETING)
    trade = ["state", "sk_key", "spot", "sk_salary", "sk_level"]
    back = back.groupBy(*trade, F.coalesce("plus", F.lit(-1)).alias("plus")).agg(*again)
    own = sk.join(sk_spots, ["sk_state", "sk_district"]).select(*SEEKER_SIGNATURE, "spot", F.coalesce("plus", F.lit(-1)).alias("plus"))
    out = own.join(back, [*trade, "plus"]).groupBy(*SEEKER_SIGNATURE).agg(*again)
    return out.filter("right_fit + partial_fit > 0")


def fit_counts(seekers: DataFrame, jobs: DataFrame, by: str = "job",
               scored: DataFrame | None = None) -> DataFrame:
    """AGG-01, AGG-02: right and partial fits per job or per seeker.

    Sums the sizes of the signatures on the other side; pairs of rows are never formed, nor
    pairs of signatures unless they are given as `scored`.
    """
    sk, pr = keyed_seekers(seekers), keyed_jobs(jobs)
    if by == "job":
        rows, signature, other, source, key = pr, JOB_SIGNATURE, "n_seekers", "id", "provider_job_id"
    else:
        rows, signature, other, source, key = sk, SEEKER_SIGNATURE, "n_jobs", "user_id", "seeker_id"

    def fits(category: str) -> Column:
        return F.sum(F.when(F.col("match_category") == category, F.col(other)).otherwise(0))

    if scored is None:
        sums = fit_sums(sk, pr, by)
    else:
        sums = scored.groupBy(*signature).agg(
            fits(RIGHT_FIT).alias("right_fit"), fits(PARTIAL_FIT).alias("partial_fit")
        )
    ids = rows.select(*signature, clean_str(F.col(source)).alias(key)).filter(F.col(key).isNotNull())
    return (
        skew_join(ids, sums, signature, "inner")
        .groupBy("state", key)
        .agg(F.sum("right_fit").alias("right_fit"), F.sum("partial_fit").alias("partial_fit"))
    )


def fit_totals(scored: DataFrame) -> DataFrame:
    """AGG-12: reported pairs per state and category, from signature sizes."""
    return scored.groupBy("state", "match_category").agg(
        F.sum(F.col("n_seekers") * F.col("n_jobs")).alias("n_pairs")
    )


def match_totals(seekers: DataFrame, jobs: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    """AGG-12: the pairs that `match` reports per state and category, without forming them."""
    sk, pr = keyed_seekers(only_states(seekers, states)), keyed_jobs(only_states(jobs, states))
    sizes = _signatures(pr, JOB_SIGNATURE, "n_jobs")
    parts = F.inline(F.array(*[F.struct(F.lit(name).alias("match_category"), (F.col("n_jobs") * F.col(c)).alias("n_pairs"))
                               for name, c in ((RIGHT_FIT, "right_fit"), (PARTIAL_FIT, "partial_fit"))]))
    rows = fit_sums(sk, pr).join(sizes, JOB_SIGNATURE).select("state", parts).filter("n_pairs > 0")
    return rows.groupBy("state", "match_category").agg(F.sum("n_pairs").alias("n_pairs"))


def enrich_seekers(seekers: DataFrame, users: DataFrame, members: DataFrame, orgs: DataFrame) -> DataFrame:
    """JN-04..JN-06 on the seeker's side.

    The lookups are left joins on unique keys, so they commute with the joins
    of the expansion; here they touch each seeker once instead of each pair.
    """
    emails = first_per_key(
        users.withColumns({"user_id": F.col("id"), "seeker_email": F.col("email")}), ["state", "user_id"], ["seeker_email"])
    names = first_per_key(
        orgs.withColumns({"organization_id": F.col("id"), "seeker_org_name": F.col("name")}),
        ["state", "organization_id"], ["seeker_org_name"])
    firsts = first_org_per_user(members.drop("side"))
    member_orgs = skew_join(firsts, names, ["state", "organization_id"]).withColumnRenamed("organization_id", "seeker_org_id")
    person = emails.join(member_orgs, ["state", "user_id"], "full")
    return skew_join(seekers, person, ["state", "user_id"])


def enrich_jobs(jobs: DataFrame, users: DataFrame) -> DataFrame:
    """JN-07 on the job's side."""
    named = {"created_by": "id", "provider_contact_name": "name", "provider_contact_phone": "phone_number",
             "provider_contact_email": "email"}
    contacts = first_per_key(
        users.withColumns({a: F.col(c) for a, c in named.items()}), ["state", "created_by"], [a for a in named if a != "created_by"])
    return skew_join(jobs, contacts, ["state", "created_by"])


def match_report(seekers: DataFrame, jobs: DataFrame, users_seeker: DataFrame,
                 members: DataFrame, orgs: DataFrame, users_provider: DataFrame,
                 states: Sequence[str] | None = None, display: bool = False,
                 scored: DataFrame | None = None) -> DataFrame:
    """PRJ-12: the 35 columns of the match table (plus state), typed or for display.

    `scored` takes signatures that have been scored already.
    """
    sk = keyed_seekers(only_states(seekers, states))
    pr = keyed_jobs(only_states(jobs, states))
    rich_sk = enrich_seekers(sk, users_seeker, members, orgs)
    rich_pr = enrich_jobs(pr, users_provider)

    def texts(df: DataFrame, names: dict[str, str]) -> list[Column]:
        return [
            (trimmed(F.col(c)) if c in df.columns else F.lit("")).alias(out)
            for out, c in names.items()
        ]

    seeker_side = rich_sk.select(
        *SEEKER_SIGNATURE, F.col("id").alias("seeker_row"),
        *texts(rich_sk, {
            "seeker_id": "user_id", "seeker_name": "name", "seeker_phone": "phone",
            "seeker_email": "seeker_email", "seeker_iti_full": "iti_specialization",
            "seeker_role": "role", "seeker_location_district": "llm_location_district",
            "seeker_location_state": "llm_location_state",
            "seeker_expected_salary": "monthly_in_hand_preferred",
            "seeker_qualification": "highest_qualification",
            "seeker_org_id": "seeker_org_id", "seeker_org_name": "seeker_org_name",
        }),
    )
    job_side = rich_pr.select(
        *JOB_SIGNATURE, F.col("pr_role").alias("job_normalised_title"),
        *texts(rich_pr, {
            "provider_job_id": "id", "job_role": "role", "job_title": "title",
            "provider_org_name": "organization_name", "provider_org_id": "organization_id",
            "job_location_district": "llm_location_district",
            "job_location_state": "llm_location_state",
            "job_salary_min": "min_monthly_in_hand", "job_salary_max": "max_monthly_in_hand",
            "job_min_education": "min_education_level", "job_openings": "positions",
            "provider_contact_name": "provider_contact_name",
            "provider_contact_phone": "provider_contact_phone",
            "provider_contact_email": "provider_contact_email",
        }),
    )
    pct = percent_text if display else percent
    if scored is None:
        rows = matched(seeker_side.drop("seeker_row"), job_side)
    else:
        rows = expand(scored, seeker_side, job_side)
    return rows.select(
        "state", "seeker_id", "provider_job_id", "match_category",
        percent_even(F.col("confidence")).alias("confidence_score_%"),
        S.confidence_label(F.col("confidence")).alias("confidence_label"),
        percent(F.col("role_score")).alias("role_match_%"),
        pct(F.col("location_score")).alias("location_match_%"),
        pct(F.col("salary_score")).alias("salary_match_%"),
        pct(F.col("education_score")).alias("education_match_%"),
        "job_role", "job_title", "job_normalised_title",
        "seeker_name", "seeker_phone", "seeker_email",
        F.col("best_trade").alias("seeker_matched_trade"), "seeker_iti_full", "seeker_role",
        "seeker_location_district", "seeker_location_state", "seeker_expected_salary",
        "seeker_qualification", "seeker_org_id", "seeker_org_name",
        "provider_org_name", "provider_org_id", "job_location_district", "job_location_state",
        "job_salary_min", "job_salary_max", "job_min_education", "job_openings",
        "provider_contact_name", "provider_contact_phone", "provider_contact_email",
    )


def sort_matches(df: DataFrame) -> DataFrame:
    """SRT-01: adds `rank`: best confidence first within a state, ids break ties. A reader can rely on it
    whatever the order of the files."""
    return ranked(df, ["state"], [F.desc("confidence_score_%"), F.asc("seeker_id"), F.asc("provider_job_id")])
