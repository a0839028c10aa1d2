"""The whole run: raw tables to reports (RUL-21 and the order of the stages).

Steps are plain functions over dicts of tables; `run` strings them together and
writes a stage only where its result is read several times.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklink.constants import LOCATION_COLUMNS, ROLE_COLUMNS, STATES, TEST_ORG_WORDS
from worklink.operators import extract, matching
from worklink.operators.flags import denylist_filters, flag_table
from worklink.operators.labels import Labeller, LabellerDown, label_all_locations, label_roles
from worklink.operators.stats import pending_outputs
from worklink.plans import application_fact as fact
from worklink.plans import open_roles as jobs_report
from worklink.plans import seeker_profile as seekers_report
from worklink.session import case_sensitive, stage
from worklink.sinks import runlog
from worklink.sinks.tables import CSV, target_root, with_headers, writable
from worklink.sinks.versions import read_current, replace_states

CLEANERS = {
    "profile": extract.flatten_profile,
    "organization": extract.flatten_organization,
    "job_posting": extract.flatten_posting,
    "job_application": extract.flatten_application,
    "user": extract.clean_user,
    "member": extract.clean_member,
}


#: Fields of the documents that labels, flags, matching and OPEN_ROLES read. A run that ends with this report and writes
#: no table on its way needs no others.
OPEN_ROLES_FIELDS = {
    "profile": (*LOCATION_COLUMNS["profile"], *ROLE_COLUMNS["profile"], "phone", "iti_specialization",
                "monthly_in_hand_preferred", "highest_qualification"),
    "job_posting": (*LOCATION_COLUMNS["job_posting"], "role", "job_title", "positions", "job_description",
                    "min_monthly_in_hand", "max_monthly_in_hand", "min_education_level"),
}


def kind_of(table: str) -> str:
    """Logical table of a name such as user_seeker or org_provider."""
    base = table.removesuffix("_seeker").removesuffix("_provider")
    return "organization" if base == "org" else base


def by_side(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """SRC-04: tables as the databases hold them (user, member, organization with a column `side`) as `run` takes them."""
    out = {t: df for t, df in tables.items() if t not in ("user", "member", "organization")}
    for table, name in (("user", "user"), ("member", "member"), ("organization", "org")):
        if table in tables:
            for side in ("seeker", "provider"):
                out[f"{name}_{side}"] = tables[table].filter(F.col("side") == side)
    return out


def clean(raw: dict[str, DataFrame], columns: dict[str, Collection[str]] | None = None) -> dict[str, DataFrame]:
    """Flattened and cleaned tables; of the documents named in `columns` only these fields, without the documents themselves."""
    columns = columns or {}
    return {t: CLEANERS[kind_of(t)](df, columns[t]).drop("metadata") if t in columns else clean_one(t, df) for t, df in raw.items()}


def clean_one(table: str, df: DataFrame) -> DataFrame:
    return CLEANERS[kind_of(table)](df)


def enrich(tables: dict[str, DataFrame], places: Labeller | DataFrame,
           roles: Labeller | DataFrame, **options) -> dict[str, DataFrame]:
    """Place and role labels."""
    return {t: enrich_one(t, df, places, roles, **options) for t, df in tables.items()}


def enrich_one(table: str, df: DataFrame, places: Labeller | DataFrame, roles: Labeller | DataFrame, **options) -> DataFrame:
    kind = kind_of(table)
    store = options.pop("store", None)
    located = label_all_locations({kind: df}, places, store=store and f"{store}/places", **options)
    return label_roles(located, roles, store=store and f"{store}/roles", **options)[kind]


def flag_all(tables: dict[str, DataFrame], deny: DataFrame, domains: Sequence[str] = (),
             words: Sequence[str] = TEST_ORG_WORDS) -> dict[str, DataFrame]:
    """Flags of every table; members last, by the organisations of their own side."""
    out: dict[str, DataFrame] = {}
    filters = denylist_filters(deny)
    for t in sorted(tables, key=lambda t: kind_of(t) == "member"):
        out[t] = flag_one(t, tables[t], out, deny, domains, words, filters)
    return out


def flag_one(table: str, df: DataFrame, flagged: dict[str, DataFrame], deny: DataFrame,
             domains: Sequence[str] = (), words: Sequence[str] = TEST_ORG_WORDS, filters=None) -> DataFrame:
    """Flags of one table; `flagged` holds the organisations that members look up, `filters` those of a large list."""
    kind = kind_of(table)
    orgs = flagged[table.replace("member", "org")] if kind == "member" else None
    return flag_table(df, kind, deny, domains, words, orgs, filters)


REPORTS = {
    "OPEN_ROLES": jobs_report.HEADERS,
    "job_application": fact.HEADERS,
    "seeker_profile": seekers_report.HEADERS,
}


#: Tables that a report reads.
NEEDS = {
    "matches": ("profile", "job_posting", "user_seeker", "member_seeker", "org_seeker", "user_provider"),
    "OPEN_ROLES": ("profile", "job_posting", "user_provider", "job_application"),
    "job_application": ("job_application", "job_posting", "org_provider", "user_provider", "user_seeker", "profile",
                        "member_seeker", "org_seeker"),
    "seeker_profile": ("profile", "job_posting", "user_seeker", "member_seeker", "org_seeker", "job_application"),
}


def build_report(name: str, t: dict[str, DataFrame], scored: DataFrame | None, as_of=None) -> DataFrame:
    """One report, or the match table, with its partition column `state`; `scored` are the scored signatures."""
    if name == "matches":
        return matching.sort_matches(matching.match_report(
            t["profile"], t["job_posting"], t["user_seeker"], t["member_seeker"], t["org_seeker"], t["user_provider"],
            scored=scored))
    if name == "OPEN_ROLES":
        fit = matching.fit_counts(t["profile"], t["job_posting"], "job", scored)
        return jobs_report.open_roles(t["job_posting"], t["user_provider"], t["job_application"], fit, as_of)
    if name == "job_application":
        return fact.application_fact(*[t[n] for n in NEEDS[name]]).withColumnRenamed("data_state", "state")
    fit = matching.fit_counts(t["profile"], t["job_posting"], "seeker", scored)
    return seekers_report.seeker_profile(
        t["profile"], t["user_seeker"], t["member_seeker"], t["org_seeker"], t["job_application"], fit, as_of)


def display_report(name: str, report: DataFrame, headers: Sequence[str] = ()) -> DataFrame:
    """SNK-04: a report under its published headers, in the order of the destination's `headers`, behind `state`."""
    published = {c: h for c, h in REPORTS[name].items() if c != "state"}
    return with_headers(report, published, headers, ["state"])


@dataclass(frozen=True)
class RunResult:
    """Paths of the reports that were written, (state, report) pairs that were skipped, errors of lost tables."""

    reports: dict[str, str]
    skipped: list[tuple[str, str]]
    errors: list[str]


def run(spark: SparkSession, raw: dict[str, DataFrame], root: str, deny: DataFrame,
        places: Labeller | DataFrame, roles: Labeller | DataFrame, as_of=None,
        states: Sequence[str] | None = None, domains: Sequence[str] = (),
        words: Sequence[str] = TEST_ORG_WORDS, test: bool = False, resume: bool = False,
        headers: dict[str, list[str]] | None = None) -> RunResult:
    """Everything from raw tables to written reports, run log and history.

    `raw` is keyed like the fields of Bundle. Stage tables go below `<root>/processed`, reports, the tables
    as text and the logs below the production or test target. Every table replaces exactly the states of the run
    (`sinks.versions`): a state that became empty reads as empty, other states stay, and a run that
    breaks off leaves the old tables whole. What a labeller answered is kept below `<root>/labels`; later runs send only texts it
    does not hold. With `resume`, what the manifest holds as done for a state is neither built nor
    written; otherwise the manifest starts anew for the states of the run. Reports are also written as `tabs/<report>`, CSV
    under the published headers; `headers` gives those that a report's destination has, in its order. A
    table or report that fails is noted and the run goes on; a labeller that does not answer its first batch
    ends it (LabellerDown). Rows are counted while they are written.
    """
    started = datetime.now(timezone.utc)
    wanted = list(states or STATES)
    processed, target = f"{root.rstrip('/')}/processed", target_root(root, test)
    run_id = started.strftime("%Y%m%dT%H%M%S%f")
    errors: list[str] = []

    def replaced(df: DataFrame, path: str, of: Sequence[str] = wanted, fmt: str = "parquet", stringify: bool = False) -> dict[str, int]:
        return replace_states(writable(df, fmt, stringify), path, run_id, of, fmt, **(CSV if fmt == "csv" else {}))

    counts: dict[str, dict[str, int]] = {}

    def written(makers: dict[str, Callable[[], DataFrame]], step: str) -> dict[str, DataFrame]:
        """Each step writes a folder of its own and the next one reads the run's states of it."""
        done, failed = runlog.publish_all(makers, lambda df, name: replaced(df, f"{processed}/{step}/{name}"), (LabellerDown,))
        errors.extend(failed)
        counts.update(done)
        return {t: read_current(spark, f"{processed}/{step}/{t}", wanted) for t in done}

    flat = written({t: lambda t=t, df=df: clean_one(t, matching.only_states(df, wanted)) for t, df in raw.items()}, "flat")
    labelled = written(
        {t: lambda t=t, df=df: enrich_one(t, df, places, roles, check_first=True, store=f"{root.rstrip('/')}/labels") for t, df in flat.items()}, "labelled")
    tables: dict[str, DataFrame] = {}
    filters = denylist_filters(deny)
    counts.clear()  # of the flagged tables, the last step
    for members in (False, True):
        tables |= written({
            t: lambda t=t, df=df: flag_one(t, df, tables, deny, domains, words, filters)
            for t, df in labelled.items() if (kind_of(t) == "member") == members}, "flagged")
    errors.extend(runlog.publish_all(
        {t: lambda df=df: df for t, df in tables.items()},
        lambda df, name: replaced(df, f"{target}/tables/{name}", fmt="csv", stringify=True))[1])

    manifest = f"{target}/_manifest"
    if not resume:
        runlog.forget(spark, manifest, wanted)
    expected = spark.createDataFrame([(s, n) for s in wanted for n in NEEDS], "state string, name string")
    todo = pending_outputs(expected, runlog.read_manifest(spark, manifest), ["state", "name"])
    pending = {(r.state, r.name) for r in todo.collect()}
    paths = {}
    scored = None
    for name in NEEDS:
        own = sorted(s for s, n in pending if n == name)
        if not own:
            continue
        lost = [t for t in NEEDS[name] if t not in tables]
        if lost:
            errors.append(f"{name}: needs {', '.join(lost)}")
            continue
        if scored is None and name != "job_application":
            # fits of all pending outputs come from one scoring
            some = {s for s, n in pending if n != "job_application"}
            scored = stage(matching.scored_signatures(
                *[key(matching.only_states(tables[t], sorted(some)))
                  for key, t in ((matching.keyed_seekers, "profile"), (matching.keyed_jobs, "job_posting"))]))

        def make(name=name, own=own) -> DataFrame:
            return build_report(name, {t: matching.only_states(df, own) for t, df in tables.items()}, scored, as_of)

        def tab(name=name, own=own) -> DataFrame:
            return display_report(name, read_current(spark, f"{target}/{name}", own), (headers or {}).get(name, ()))

        done, failed = runlog.publish_all({name: make}, lambda df, name: replaced(df, f"{target}/{name}", own))
        if done and name in REPORTS:
            with case_sensitive(spark):
                failed += runlog.publish_all(
                    {name: tab}, lambda df, name: replaced(df, f"{target}/tabs/{name}", own, "csv", stringify=True))[1]
        errors.extend(failed)
        if done and not failed:
            paths[name] = f"{target}/{name}"
            runlog.record_done(spark.createDataFrame(list(done[name].items()), "state string, n_rows long"), manifest, name)
    runlog.append_row(runlog.run_log_row(
        runlog.counted(spark, counts), runlog.state_names(wanted, list(raw)), started, errors=errors), f"{target}/_log")
    if not test:
        listed = {"seekers": "profile", "job_postings": "job_posting", "job_applications": "job_application"}
        history = {n: counts[t] for n, t in listed.items() if t in counts}
        history["matches"] = runlog.done_counts(spark, manifest, "matches", wanted)
        runlog.append_row(runlog.history_row(runlog.counted(spark, history), wanted, names=list(history)), f"{target}/_history")
    return RunResult(paths, sorted((s, n) for s in wanted for n in NEEDS if (s, n) not in pending), errors)
