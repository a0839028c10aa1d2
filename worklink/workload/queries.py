"""The registered queries: each runs over whole tables of the driver.

A query is a function of (spark, sf_dir); its SQL restatement, where SQL can
say the same, sits next to it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklink.constants import ROLE_FIELDS
from worklink.functions import scores as S
from worklink.functions import text as X
from worklink.functions import variant as V
from worklink.operators import extract, flags, keyed, labels, matching, similarity, stats
from worklink.plans import open_roles as roles
from worklink.plans import rules
from worklink.plans import seeker_profile as seekers
from worklink.plans.application_fact import application_fact
from worklink.plans.pipeline import OPEN_ROLES_FIELDS, clean, enrich, flag_all
from worklink.session import configure, scratch, stage
from worklink.sinks import runlog
from worklink.sinks.tables import BOM, align_to_headers, all_text, with_headers, write_table
from worklink.sinks.versions import read_current, replace_states
from worklink.sources.files import read_table
from worklink.workload import oracle_sql as O
from worklink.workload.bindings import AS_OF, bind, with_clause
from worklink.workload.oracle_json import flatten_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DOMAINS = ["internal.example"]
c = F.col


def query(sql: str | None = None, name: str | None = None):
    def register(run: Query) -> Query:
        key = name or run.__name__

        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        QUERIES[key] = configured
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def b(name: str) -> str:
    return with_clause(name)


# ------------------------------------------------------------ scalar functions

LINES = f"list_filter(list_transform(string_split(text, chr(10)), lambda x: {O.strip('x')}), lambda x: x <> '')"


@query(f"SELECT doc_id, lang, length({O.strip('text')}) AS n, md5({O.strip('text')}) AS digest FROM documents")
def fn_clean_str(spark, d):
    """FN-01 over whole document texts."""
    text = X.clean_str(c("text"))
    return table(spark, d, "documents").select("doc_id", "lang", F.length(text).alias("n"), F.md5(text).alias("digest"))


@query(f"""{b('phones')} SELECT c_custkey, {O.phone('phone_raw')} AS phone, coalesce({O.phone('phone_raw')}, '') AS shown,
  {O.digits('phone_raw')} AS digits FROM b_phones""")
def fn_clean_phone(spark, d):
    """FN-02, FN-03, FN-04."""
    raw = c("phone_raw")
    return bind(spark, d, "phones").select(
        "c_custkey", X.clean_phone(raw).alias("phone"), X.display_phone(raw).alias("shown"), X.digits(raw).alias("digits"))


@query(f"""{b('raw_user')} SELECT id, lower(trim(email_verified)) IN ('t', 'true', '1', 'yes') AS verified,
  lower(trim(banned)) IN ('t', 'true', '1', 'yes') AS banned FROM b_raw_user""")
def fn_clean_bool(spark, d):
    """FN-06."""
    return bind(spark, d, "raw_user").select(
        "id", X.clean_bool(c("email_verified")).alias("verified"), X.clean_bool(c("banned")).alias("banned"))


@query(f"SELECT doc_id, md5(nullif(array_to_string({LINES}, '|'), '')) AS digest FROM documents")
def fn_join_list(spark, d):
    """FN-07 over the lines of whole document texts."""
    joined = X.join_items(F.split("text", "\n"))
    return table(spark, d, "documents").select("doc_id", F.md5(joined).alias("digest"))


@query(f"{b('job_application')} SELECT id, {O.phone_key('seeker_phone')} AS phone_key FROM b_job_application")
def fn_norm_phone(spark, d):
    """FN-05."""
    return bind(spark, d, "job_application").select("id", X.phone_key(c("seeker_phone")).alias("phone_key"))


@query(f"""{b('job_application')} SELECT id, {O.fmt(O.stamp('applied_at'))} AS applied,
  coalesce(strftime({O.stamp('applied_at')}, '%-d-%b-%Y'), '') AS applied_text, {O.age(O.stamp('applied_at'))} AS age
FROM b_job_application""")
def fn_dates_ages(spark, d):
    """FN-19..FN-22."""
    ts = X.timestamp_of(c("applied_at"))
    return bind(spark, d, "job_application").select(
        "id", X.fmt_date(ts).alias("applied"), X.fmt_date_text(ts).alias("applied_text"),
        X.age_days(ts, stats.as_of_date(AS_OF)).alias("age"))


@query(f"""{b('job_posting')} SELECT id, round((epoch({O.stamp('created_at')}) - epoch(TIMESTAMP '1899-12-30 00:00:00')
  - epoch({O.stamp('created_at')}) %% 1) / 86400, 6) AS serial FROM b_job_posting""".replace("%%", "%"))
def fn_sheet_serial(spark, d):
    """FN-25."""
    return bind(spark, d, "job_posting").select(
        "id", F.round(X.sheet_serial(X.timestamp_of(c("created_at"))), 6).alias("serial"))


@query(f"{b('job_posting')} SELECT id, {O.salary('min_monthly_in_hand', 'max_monthly_in_hand')} AS salary FROM b_job_posting")
def fn_fmt_salary(spark, d):
    """FN-23."""
    return bind(spark, d, "job_posting").select("id", roles.posting_salary().alias("salary"))


@query(f"""{b('job_posting')} SELECT id, {O.number('positions')} AS n, {O.to_num('positions')} AS shown,
  {O.to_num('max_monthly_in_hand')} AS top FROM b_job_posting""")
def fn_to_num(spark, d):
    """FN-17, FN-18."""
    return bind(spark, d, "job_posting").select(
        "id", X.number(c("positions")).alias("n"), X.to_num_text(c("positions")).alias("shown"),
        X.to_num_text(c("max_monthly_in_hand")).alias("top"))


@query(f"""{b('profile')} SELECT id, {O.edu_level('highest_qualification')} AS level FROM b_profile""")
def fn_edu_level(spark, d):
    """FN-36."""
    return bind(spark, d, "profile").select("id", S.edu_level(c("highest_qualification")).alias("level"))


@query(f"""{b('profile')} SELECT id, array_to_string(list_filter(list_transform(string_split(iti_specialization, '|'),
  lambda x: trim(x)), lambda x: x <> ''), ';') AS parts FROM b_profile""")
def fn_split_parts(spark, d):
    """FN-28."""
    return bind(spark, d, "profile").select("id", F.array_join(X.split_parts(c("iti_specialization")), ";").alias("parts"))


@query(f"""{b('job_posting')}, t AS (SELECT id, lower(trim(title)) AS a, lower(trim(coalesce(llm_title_normalized, ''))) AS b FROM b_job_posting)
SELECT id, contains(a, b) OR contains(b, a) AS related FROM t""")
def fn_contains_bidir(spark, d):
    """FN-29; a missing text counts as an empty one."""
    jobs = bind(spark, d, "job_posting")
    return jobs.select("id", X.contains_either(c("title"), c("llm_title_normalized")).alias("related"))


@query(f"""{b('org_provider')} SELECT state, id, string_split(contact_email, '@')[-1] AS domain,
  regexp_matches(lower(name), '\\b(test|demo|trial|sample|dummy|fake|xyz)\\b') AS test_name FROM b_org_provider""")
def fn_patterns(spark, d):
    """FN-31, FN-32."""
    return bind(spark, d, "org_provider").select(
        "state", "id", X.email_domain(c("contact_email")).alias("domain"),
        flags.bad_org_pattern(c("name")).alias("test_name"))


@query("""SELECT percent, shown, count(*) AS n FROM (SELECT round(l_discount * 100, 1) AS percent,
  CAST(round(l_discount * 100, 1) AS VARCHAR) AS shown FROM lineitem) GROUP BY percent, shown""")
def fn_percent(spark, d):
    """FN-26."""
    rows = table(spark, d, "lineitem").select(
        X.percent(c("l_discount")).alias("percent"), X.percent_text(c("l_discount")).alias("shown"))
    return rows.groupBy("percent", "shown").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------ JSON documents

@query(flatten_sql("profile", "raw_profile", ["state", "id"]))
def json_flatten_profile(spark, d):
    """PRJ-01, FN-08..FN-14."""
    return extract.flatten_profile(bind(spark, d, "raw_profile")).drop("metadata")


@query(flatten_sql("organization", "raw_organization", ["id"]))
def json_flatten_org(spark, d):
    """PRJ-02."""
    return extract.flatten_organization(bind(spark, d, "raw_organization")).drop("metadata", "name")


@query(flatten_sql("job_posting", "raw_posting", ["id"]))
def json_flatten_posting(spark, d):
    """PRJ-03, RUL-01."""
    return extract.flatten_posting(bind(spark, d, "raw_posting")).drop("metadata", "state", "title", "description")


@query(flatten_sql("job_application", "raw_application", ["id"]))
def json_flatten_application(spark, d):
    """PRJ-04."""
    return extract.flatten_application(bind(spark, d, "raw_application")).drop(
        "metadata", "contact", "location", "user_name")


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.k') <> '0' AS present,
  CAST(NULL AS VARCHAR) AS missing FROM events""")
def json_truthy(spark, d):
    """FN-08, FN-10, FN-11 on the documents of the event table."""
    events = table(spark, d, "events").withColumn("v", V.parse_obj(c("props")))
    return events.select(
        "event_id", V.get_text(c("v"), "k").alias("k"), V.truthy(V.get(c("v"), "k")).alias("present"),
        V.get_text(c("v"), "none").alias("missing"))


@query(f"""{b('profile')} SELECT id, {O.gps('lat')} AS lat, {O.gps('lng')} AS lng FROM b_profile""")
def json_gps(spark, d):
    """FN-24."""
    docs = bind(spark, d, "profile").select("id", V.parse_obj(c("metadata")).alias("m"))
    lat, lng = seekers.gps(c("m"))
    return docs.select("id", lat.alias("lat"), lng.alias("lng"))


@query(f"""{b('job_posting')} SELECT id, json_extract_string(location, '$.city') AS at_city, CAST(NULL AS VARCHAR) AS at_state,
  CAST(NULL AS VARCHAR) AS at_address, CAST(NULL AS VARCHAR) AS at_country, CAST(NULL AS VARCHAR) AS at_lat,
  CAST(NULL AS VARCHAR) AS at_lng FROM b_job_posting""")
def json_location_columns(spark, d):
    """PRJ-07."""
    docs = bind(spark, d, "job_posting").withColumn("v", V.parse_obj(c("location")))
    return docs.select("id", *extract.location_columns(c("v"), "at"))


# ------------------------------------------------------------ cleaning and projection

@query(f"""{b('raw_user')} SELECT state, id, nullif(trim(name), '') AS name, nullif(trim(email), '') AS email, nullif(trim(role), '') AS role,
  lower(trim(email_verified)) IN ('t', 'true', '1', 'yes') AS email_verified,
  lower(trim(banned)) IN ('t', 'true', '1', 'yes') AS banned, {O.phone('phone_number')} AS phone_number FROM b_raw_user""")
def clean_user(spark, d):
    """PRJ-05."""
    return extract.clean_user(bind(spark, d, "raw_user"))


@query(f"{b('member')} SELECT state, side, user_id, organization_id, nullif(trim(role), '') AS role, created_at FROM b_member")
def clean_member(spark, d):
    """PRJ-06."""
    return extract.clean_member(bind(spark, d, "member"))


PLACE_COLUMNS = ["location_city", "location_state", "current_location", "hometown"]


@query(f"""{b('profile')} SELECT id, concat_ws(', ', nullif(trim(location_city), ''), nullif(trim(location_state), ''),
  nullif(trim(current_location), '')) AS place FROM b_profile""")
def location_text(spark, d):
    """PRJ-11; the fourth column does not exist and is left out."""
    profiles = bind(spark, d, "profile")
    return profiles.select("id", labels.location_text(profiles, PLACE_COLUMNS).alias("place"))


@query(f"""{b('profile')} SELECT CAST(NULL AS VARCHAR) AS extra, user_id, nullif(llm_location_state, '') AS llm_location_state,
  id, nullif(age, '') AS age FROM b_profile""")
def align_headers(spark, d):
    """PRJ-10."""
    rows = bind(spark, d, "profile").select("id", "user_id", "age", "llm_location_state")
    return align_to_headers(rows, ["extra", "user_id", "llm_location_state", "", ""])


@query(f"""{b('profile')} SELECT coalesce(id, '') AS id, coalesce(name, '') AS name, coalesce(phone, '') AS phone,
  coalesce(age, '') AS age, coalesce(created_at, '') AS created_at FROM b_profile""")
def publish_text(spark, d):
    """SNK-05: every value as text."""
    return all_text(bind(spark, d, "profile").select("id", "name", "phone", "age", "created_at"))


# ------------------------------------------------------------ scans and sinks

@query(f"{b('job_posting')} SELECT state, id, nullif(role, '') AS role, nullif(organization_name, '') AS organization_name FROM b_job_posting")
def csv_scan(spark, d):
    """SRC-05..SRC-07, SNK-01..SNK-03: postings as CSV with nested columns and a byte-order mark, some columns read again."""
    jobs = job_rows(spark, d).select("state", "id", "role", "organization_name", F.struct("id", "role").alias("nested"))
    path = write_table(jobs, scratch(spark, "csv"), "job_posting", "csv", bom=True)
    rows = read_table(spark, path, "csv")
    first = rows.columns[0]
    return rows.withColumnRenamed(first, first.lstrip(BOM)).select("state", "id", "role", "organization_name")


@query(f"""{b('job_posting')} SELECT state, count(*) AS n_rows, CAST(sum(length(nested)) AS BIGINT) AS n_chars FROM (SELECT state, '{{"id":"' || id || '"'
  || CASE WHEN role IS NULL THEN '' ELSE ',"role":"' || role || '"' END || '}}' AS nested FROM b_job_posting) GROUP BY state""")
def csv_nested(spark, d):
    """SNK-01, SNK-02: nested values arrive as JSON text."""
    jobs = job_rows(spark, d).select("state", "id", F.struct("id", "role").alias("nested"))
    rows = read_table(spark, write_table(jobs, scratch(spark, "csv"), "job_posting", "csv"), "csv")
    return rows.groupBy("state").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("nested")).alias("n_chars"))


@query(f"""{with_clause('profile', 'job_posting')} SELECT 'profile' AS name, state, count(*) AS n_rows FROM b_profile GROUP BY state
UNION ALL SELECT 'job_posting', state, count(*) FROM b_job_posting WHERE state = 'KA' GROUP BY state""")
def load_tables(spark, d):
    """SRC-09, SRC-12, SNK-10: tables partitioned by state, one state of one of them, and one that is not there."""
    root = scratch(spark, "tables")
    for name, rows in (("profile", seeker_rows(spark, d)), ("job_posting", job_rows(spark, d))):
        write_table(rows.select("state", "id"), root, name)
    read = {n: read_table(spark, f"{root}/{n}", "parquet", columns=["state", "id"], missing_ok=True) for n in ("profile", "job_posting", "lost")}
    read["job_posting"] = matching.only_states(read["job_posting"], ["KA"])
    counts = [df.groupBy("state").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("name"), "state", "n_rows") for n, df in read.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(f"""{b('profile')} SELECT state, id, name, 'first' AS run FROM b_profile WHERE state = 'UP'
UNION ALL SELECT state, id, name, 'second' AS run FROM b_profile WHERE state = 'KA' AND phone IS NULL""")
def replaced_states(spark, d):
    """SNK-02, SNK-04, SNK-10, FLT-08: a run of one state replaces exactly that state."""
    path, rows = scratch(spark, "versions"), seeker_rows(spark, d).select("state", "id", "name", "phone")
    replace_states(rows.withColumn("run", F.lit("first")), path, "r1", ["KA", "UP"])
    replace_states(rows.filter("phone IS NULL").withColumn("run", F.lit("second")), path, "r2", ["KA"])
    return read_current(spark, path).drop("phone")


@query(f"""{b('job_posting')} SELECT state, count(*) AS n_rows FROM b_job_posting WHERE lower(trim(status)) = 'open' GROUP BY state
UNION ALL SELECT 'XX', 0""")
def counted_writes(spark, d):
    """AGG-07, SNK-06: rows per state counted while they are written; a state without rows has 0."""
    jobs = matching.open_jobs(job_rows(spark, d), include_flagged=True).select("state", "id")
    counts = replace_states(jobs, scratch(spark, "versions"), "r1", ["KA", "UP", "XX"])
    return spark.createDataFrame(list(counts.items()), "state string, n_rows long")


PUBLISHED = {"Id": "id", "Phone Number": "phone", "trade": "iti_specialization"}


@query(f"""{b('profile')} SELECT state, nullif(id, '') AS "Id", CAST(NULL AS VARCHAR) AS "unknown", nullif(iti_specialization, '') AS trade,
  nullif(phone, '') AS "Phone Number" FROM b_profile""")
def published_headers(spark, d):
    """SNK-04, PRJ-10: columns under published headers, in the order of the destination's."""
    return with_headers(seeker_rows(spark, d), {c_: h for h, c_ in PUBLISHED.items()}, ["Id", "unknown", "trade", "", ""], ["state"])


# ------------------------------------------------------------ flags

def deny_table(spark, d):
    return flags.parse_denylist(bind(spark, d, "denylist"))


@query(f"{b('denylist')}, {O.deny()} SELECT kind, value FROM deny")
def denylist_parse(spark, d):
    """SRC-08."""
    return deny_table(spark, d)


DOC_LINES = "(SELECT unnest(string_split(text, chr(10))) AS value FROM documents)"


@query(f"WITH {O.deny(DOC_LINES)} SELECT kind, count(*) AS n, min(md5(value)) AS low, max(md5(value)) AS high FROM deny GROUP BY kind")
def denylist_parse_lines(spark, d):
    """SRC-08 over every line of the document table."""
    lines = table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    return flags.parse_denylist(lines).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.md5("value")).alias("low"), F.max(F.md5("value")).alias("high"))


@query(O.flag_sql("user_seeker", f"{O.test_phone('phone_number')} OR {O.test_email('email')}", "state, id, email"))
def flag_user(spark, d):
    """RUL-02, RUL-03, RUL-05."""
    return flags.flag_user(bind(spark, d, "user_seeker"), deny_table(spark, d), DOMAINS).select(
        "state", "id", "email", "test_flag")


@query(O.flag_sql("profile", O.test_phone("phone"), "state, id"))
def flag_profile(spark, d):
    """RUL-02, RUL-06, PRJ-20."""
    return flags.flag_profile(bind(spark, d, "profile"), deny_table(spark, d)).select("state", "id", "test_flag")


@query(O.flag_sql("phones", O.test_phone("phone_raw"), "c_custkey"))
def flag_phone(spark, d):
    """RUL-02 on phones as they were typed."""
    rows = bind(spark, d, "phones").select(F.col("c_custkey").alias("id"), F.col("phone_raw").alias("phone"))
    return flags.flag_profile(rows, deny_table(spark, d)).select(F.col("id").alias("c_custkey"), "test_flag")


@query(O.flag_sql("organization", O.ORG_RULE, "state, side, id"))
def flag_org(spark, d):
    """RUL-02..RUL-04, RUL-07."""
    return flags.flag_organization(bind(spark, d, "organization"), deny_table(spark, d), DOMAINS).select(
        "state", "side", "id", "test_flag")


@query(f"""{with_clause('organization', 'member', 'denylist')}, {O.deny()},
bad AS (SELECT state, side, id FROM b_organization WHERE {O.ORG_RULE})
SELECT m.state, m.user_id, m.organization_id, CASE WHEN bad.id IS NULL THEN 0 ELSE 1 END AS test_flag
FROM b_member m LEFT JOIN bad ON bad.state = m.state AND bad.side = m.side AND bad.id = m.organization_id""")
def flag_member_cascade(spark, d):
    """RUL-08, JN-22, FLT-13."""
    orgs = flags.flag_organization(bind(spark, d, "organization"), deny_table(spark, d), DOMAINS)
    return flags.flag_member(bind(spark, d, "member"), orgs).select("state", "user_id", "organization_id", "test_flag")


@query(O.flag_sql("job_application", f"{O.test_phone('seeker_phone')} OR {O.test_email('seeker_email')}", "state, id"))
def flag_application(spark, d):
    """RUL-09."""
    return flags.flag_application(bind(spark, d, "job_application"), deny_table(spark, d), DOMAINS).select(
        "state", "id", "test_flag")


@query(O.flag_sql("job_application", f"{O.test_phone('seeker_phone')} OR {O.test_email('seeker_email')}", "state, id"))
def flag_large_list(spark, d):
    """RUL-02, RUL-09, JN-23 as for a list beyond any broadcast: a filter in the scan, exact joins of the hits only."""
    deny = deny_table(spark, d)
    return flags.flag_application(
        bind(spark, d, "job_application"), deny, DOMAINS, filters=flags.denylist_filters(deny, 0)).select("state", "id", "test_flag")


@query(O.flag_sql("job_posting", O.test_org("organization_name"), "state, id"))
def flag_posting(spark, d):
    """RUL-04, RUL-10."""
    return flags.flag_posting(bind(spark, d, "job_posting"), deny_table(spark, d)).select("state", "id", "test_flag")


@query(f"""{with_clause('organization', 'job_posting', 'profile', 'user_seeker', 'job_application', 'member', 'denylist')}, {O.deny()},
bad AS (SELECT state, side, id FROM b_organization WHERE {O.ORG_RULE}),
t AS (SELECT 'organization' AS name, CAST({O.ORG_RULE} AS INT) AS f FROM b_organization
  UNION ALL SELECT 'job_posting', CAST({O.test_org('organization_name')} AS INT) FROM b_job_posting
  UNION ALL SELECT 'profile', CAST({O.test_phone('phone')} AS INT) FROM b_profile
  UNION ALL SELECT 'user', CAST({O.test_phone('phone_number')} OR {O.test_email('email')} AS INT) FROM b_user_seeker
  UNION ALL SELECT 'job_application', CAST({O.test_phone('seeker_phone')} OR {O.test_email('seeker_email')} AS INT) FROM b_job_application
  UNION ALL SELECT 'member', CASE WHEN bad.id IS NULL THEN 0 ELSE 1 END FROM b_member m
    LEFT JOIN bad ON bad.state = m.state AND bad.side = m.side AND bad.id = m.organization_id)
SELECT coalesce(name, 'total') AS name, count(*) AS n_rows, CAST(sum(f) AS BIGINT) AS n_flagged FROM t GROUP BY ROLLUP (name)""")
def flag_totals(spark, d):
    """RUL-11, AGG-08 over all six kinds of tables."""
    deny = deny_table(spark, d)
    sources = {"organization": "organization", "job_posting": "job_posting", "profile": "profile", "user": "user_seeker",
               "job_application": "job_application"}
    done = {t: flags.flag_table(bind(spark, d, source), t, deny, DOMAINS) for t, source in sources.items()}
    done["member"] = flags.flag_table(bind(spark, d, "member"), "member", deny, organizations=done["organization"])
    return flags.flag_totals(done)


# ------------------------------------------------------------ matching

def seeker_rows(spark, d):
    return bind(spark, d, "profile")


def job_rows(spark, d):
    return bind(spark, d, "job_posting")


@query(f"{O.match_with()} SELECT state, id, pr_role, pr_level AS level FROM pr")
def open_jobs(spark, d):
    """FLT-01, FLT-02, PRJ-17."""
    jobs = matching.keyed_jobs(job_rows(spark, d))
    return jobs.select("state", "id", "pr_role", F.nullif("pr_level", F.lit(0)).alias("level"))


@query(f"{O.match_with()} SELECT state, id, sk_key, sk_level AS level FROM sk")
def clean_seekers(spark, d):
    """FLT-03, FLT-04, PRJ-16."""
    rows = matching.keyed_seekers(seeker_rows(spark, d))
    return rows.select("state", "id", "sk_key", F.nullif("sk_level", F.lit(0)).alias("level"))


@query(f"{O.match_with()} SELECT sk_key, pr_role, role_score, best_trade FROM pairs")
def role_pairs(spark, d):
    """UDF-01, RUL-12..RUL-14, JN-01, FLT-05, AGG-11, OPT-03."""
    return matching.role_pairs(
        matching.keyed_seekers(seeker_rows(spark, d)), matching.keyed_jobs(job_rows(spark, d)))


@query(f"""WITH RECURSIVE product AS (SELECT p.p_name AS a, q.p_type || ' ' || q.p_name AS b FROM
  (SELECT DISTINCT p_name FROM part) p, (SELECT DISTINCT p_type, p_name FROM part) q), {O.token_set('product')}
SELECT a AS left_value, b AS right_value, round(score, 6) AS score FROM scored WHERE score >= 0.6::DOUBLE""")
def similar_texts(spark, d):
    """UDF-01, RUL-12: the similarity join by itself, on all distinct names of parts."""
    part = table(spark, d, "part")
    left = part.select(c("p_name").alias("value")).distinct()
    right = part.select(F.concat_ws(" ", "p_type", "p_name").alias("value")).distinct()
    pairs = similarity.scored_pairs(left, right, 0.6)
    return pairs.withColumn("score", F.round("score", 6))


APPLIED = """applied AS (SELECT a.id, p.*, j.llm_location_state AS j_state, j.llm_location_district AS j_district,
  j.min_monthly_in_hand, j.max_monthly_in_hand, j.min_education_level, a.job_id
  FROM b_job_application a LEFT JOIN (SELECT state, id AS pid, llm_location_state, llm_location_district, monthly_in_hand_preferred,
    highest_qualification FROM b_profile) p ON p.state = a.state AND p.pid = a.user_id
  LEFT JOIN b_job_posting j ON j.state = a.state AND j.id = a.job_id)"""
APPLIED_WITH = f"{with_clause('job_application', 'profile', 'job_posting')}, {APPLIED}"
SQL_LOC = O.location_score("llm_location_state", "j_state", "llm_location_district", "j_district")
SQL_SAL = O.salary_score(*[f"({O.number(x)})" for x in (
    "monthly_in_hand_preferred", "min_monthly_in_hand", "max_monthly_in_hand")])
SQL_EDU = O.education_score(O.edu_level("highest_qualification"), O.edu_level("min_education_level"))


def applied(spark, d):
    """Each application with its seeker and its job, where they are known."""
    profile = seeker_rows(spark, d).select(
        "state", c("id").alias("user_id"), "llm_location_state", "llm_location_district",
        "monthly_in_hand_preferred", "highest_qualification")
    job = job_rows(spark, d).select(
        "state", c("id").alias("job_id"), c("llm_location_state").alias("j_state"),
        c("llm_location_district").alias("j_district"), "min_monthly_in_hand",
        "max_monthly_in_hand", "min_education_level")
    apps = bind(spark, d, "job_application").select("state", "id", "user_id", "job_id")
    return keyed.skew_join(keyed.skew_join(apps, job, ["state", "job_id"]), profile, ["state", "user_id"])


def location():
    return S.location_score(
        c("llm_location_state"), c("j_state"), c("llm_location_district"), c("j_district"))


def salary():
    return S.salary_score(*[X.number(c(x)) for x in (
        "monthly_in_hand_preferred", "min_monthly_in_hand", "max_monthly_in_hand")])


def education():
    return S.education_score(
        S.edu_level(c("highest_qualification")), S.edu_level(c("min_education_level")))


@query(f"{APPLIED_WITH} SELECT id, {SQL_LOC} AS score FROM applied")
def score_location(spark, d):
    """RUL-15."""
    return applied(spark, d).select("id", location().alias("score"))


@query(f"{APPLIED_WITH} SELECT id, {SQL_SAL} AS score FROM applied")
def score_salary(spark, d):
    """RUL-16."""
    return applied(spark, d).select("id", salary().alias("score"))


@query(f"{APPLIED_WITH} SELECT id, {SQL_EDU} AS score FROM applied")
def score_education(spark, d):
    """RUL-17."""
    return applied(spark, d).select("id", education().alias("score"))


SQL_ROLE = "CASE CAST(job_id AS BIGINT) % 4 WHEN 0 THEN NULL WHEN 1 THEN 0.5::DOUBLE WHEN 2 THEN 0.25::DOUBLE WHEN 3 THEN 1::DOUBLE END"


@query(f"""{APPLIED_WITH}, s AS (SELECT id, {SQL_ROLE} AS r, {SQL_LOC} AS l, {SQL_SAL} AS s, {SQL_EDU} AS e FROM applied),
k AS (SELECT *, {O.confidence('r', 'l', 's', 'e')} AS confidence FROM s)
SELECT id, round(confidence, 6) AS confidence, CASE WHEN confidence >= 0.8::DOUBLE THEN 'High' WHEN confidence >= 0.6::DOUBLE THEN 'Medium'
  WHEN confidence >= 0.4::DOUBLE THEN 'Low' ELSE 'Very Low' END AS label,
  CASE WHEN r >= 0.5 AND l >= 0.5 THEN 'Right Fit' WHEN r >= 0.5 THEN 'Partial Fit' END AS category FROM k""")
def score_confidence(spark, d):
    """RUL-18..RUL-20, AGG-15."""
    turn = c("job_id").cast("long") % 4
    role = F.when(turn == 1, 0.5).when(turn == 2, 0.25).when(turn == 3, 1.0)
    rows = applied(spark, d).select(
        "id", role.alias("r"), location().alias("l"), salary().alias("s"), education().alias("e"))
    score = S.confidence(c("r"), c("l"), c("s"), c("e"))
    return rows.select(
        "id", F.round(score, 6).alias("confidence"), S.confidence_label(score).alias("label"),
        S.fit_category(c("r"), c("l")).alias("category"))


@query(f"""{O.match_with()} SELECT state, seeker_id, provider_job_id, role_score, best_trade, location_score, salary_score,
  education_score, round(confidence, 6) AS confidence, match_category FROM matches""")
def match_pairs(spark, d):
    """RUL-20, RUL-21, FLT-06, FLT-07, JN-02, JN-03."""
    rows = matching.match(seeker_rows(spark, d), job_rows(spark, d))
    return rows.withColumn("confidence", F.round("confidence", 6))


@query(O.MATCH_REPORT)
def match_report(spark, d):
    """PRJ-12, JN-04..JN-07, FN-26, RUL-19."""
    return matching.match_report(
        seeker_rows(spark, d), job_rows(spark, d), bind(spark, d, "user_seeker"),
        bind(spark, d, "member"), bind(spark, d, "org_seeker"), bind(spark, d, "user_provider"))


@query(f"""SELECT state, seeker_id, provider_job_id, CAST(row_number() OVER (PARTITION BY state
  ORDER BY "confidence_score_%" DESC, seeker_id, provider_job_id) AS BIGINT) AS rank FROM ({O.MATCH_REPORT})""")
def match_ranked(spark, d):
    """SRT-01: the order of the match table."""
    rows = matching.match_report(
        seeker_rows(spark, d), job_rows(spark, d), bind(spark, d, "user_seeker"),
        bind(spark, d, "member"), bind(spark, d, "org_seeker"), bind(spark, d, "user_provider"))
    slim = rows.select("state", "seeker_id", "provider_job_id", "confidence_score_%")
    return matching.sort_matches(slim).drop("confidence_score_%")


@query(f"{O.match_with()} SELECT state, provider_job_id, right_fit, partial_fit FROM {O.fit_sql('provider_job_id')}")
def match_counts_job(spark, d):
    """AGG-01, FLT-11."""
    return matching.fit_counts(seeker_rows(spark, d), job_rows(spark, d), "job")


@query(f"{O.match_with()} SELECT state, seeker_id, right_fit, partial_fit FROM {O.fit_sql('seeker_id')}")
def match_counts_seeker(spark, d):
    """AGG-02, FLT-11."""
    return matching.fit_counts(seeker_rows(spark, d), job_rows(spark, d), "seeker")


@query(f"{O.match_with()} SELECT state, match_category, count(*) AS n_pairs FROM matches GROUP BY state, match_category")
def match_totals(spark, d):
    """AGG-12."""
    return matching.match_totals(seeker_rows(spark, d), job_rows(spark, d))


@query(f"{O.match_with()} SELECT state, count(*) AS n_pairs FROM matches WHERE state = 'KA' GROUP BY state")
def match_one_state(spark, d):
    """FLT-08."""
    totals = matching.match_totals(seeker_rows(spark, d), job_rows(spark, d), states=["KA"])
    return totals.groupBy("state").agg(F.sum("n_pairs").alias("n_pairs"))


# ------------------------------------------------------------ keyed operators

@query(f"""{b('user_seeker')} SELECT state, id, email, phone_number FROM
  {O.first_row('b_user_seeker', 'id', ['email', 'phone_number'], ['created_at', 'email', 'phone_number'])}""")
def dedup_keep_first(spark, d):
    """WIN-01."""
    return keyed.first_per_key(bind(spark, d, "user_seeker"), ["state", "id"], ["email", "phone_number"])


@query(f"""{b('member')} SELECT state, side, user_id, first(organization_id ORDER BY created_at NULLS LAST, organization_id)
  FILTER (organization_id IS NOT NULL) AS organization_id FROM b_member WHERE user_id IS NOT NULL GROUP BY state, side, user_id""")
def first_org_per_user(spark, d):
    """AGG-03, FLT-12."""
    return keyed.first_org_per_user(bind(spark, d, "member"))


@query(f"""{with_clause(*O.OPEN_BINDINGS)}, {O.OPEN_ROWS}
SELECT state, id, CASE WHEN copies > 1 THEN 'Yes' ELSE 'No' END AS duplicate FROM facts""")
def duplicate_postings(spark, d):
    """RUL-24, AGG-04, WIN-02, FN-33."""
    jobs = matching.open_jobs(job_rows(spark, d), include_flagged=True)
    rows = roles.with_contacts(jobs, bind(spark, d, "user_provider")).withColumn("salary", roles.posting_salary())
    return keyed.mark_duplicates(rows, roles.duplicate_key(), keep=["state"]).select("state", "id", "duplicate")


# ------------------------------------------------------------ reports

def facts(spark, d):
    return roles.with_job_facts(
        job_rows(spark, d), bind(spark, d, "user_provider"), bind(spark, d, "job_application"), AS_OF)


FACTS = f"{with_clause(*O.OPEN_BINDINGS)}, {O.OPEN_ROWS}"


@query(f"""{b('job_application')} SELECT state, key AS job_id, applications, shortlisted, rejected, last_applied, last_applied_age,
  application_pending_from, shortlisted_age, rejected_age FROM {O.app_stats('job_id', 'b_job_application')}""")
def job_app_stats(spark, d):
    """AGG-05, FN-30."""
    return stats.application_stats(bind(spark, d, "job_application"), "job_id", stats.as_of_date(AS_OF))


@query(f"{FACTS} SELECT state, id, job_age, {O.JOB_STATUS} AS status FROM facts")
def job_status(spark, d):
    """RUL-22, AGG-13."""
    return facts(spark, d).select("state", "id", "job_age", roles.status().alias("status"))


@query(f"{FACTS} SELECT state, id, {O.JOB_COMPLETION} AS completion FROM facts")
def job_completion(spark, d):
    """RUL-25, AGG-14."""
    return facts(spark, d).select("state", "id", roles.job_completion().alias("completion"))


@query(f"{FACTS} SELECT state, id, {O.PROVIDER_ACTION} AS action, {O.JOB_FOLLOW_UP} AS follow_up FROM facts")
def job_actions(spark, d):
    """RUL-27, RUL-28."""
    return facts(spark, d).select(
        "state", "id",
        rules.provider_action(c("applications"), c("shortlisted"), c("rejected"), c("job_age")).alias("action"),
        rules.job_follow_up(
            c("organization_name"), c("role"), c("positions"), c("salary"), c("job_description"), c("u_name"),
            c("u_email"), c("organization_id"), c("shortlisted"), c("rejected")).alias("follow_up"))


@query(O.open_roles_sql(fit=False))
def open_roles(spark, d):
    """RUL-31, PRJ-13, JN-08, JN-09."""
    return roles.open_roles(
        job_rows(spark, d), bind(spark, d, "user_provider"), bind(spark, d, "job_application"), as_of=AS_OF)


@query(O.open_roles_sql(fit=True))
def open_roles_with_fits(spark, d):
    """RUL-31 with JN-10."""
    fit = matching.fit_counts(seeker_rows(spark, d), job_rows(spark, d), "job")
    return roles.open_roles(
        job_rows(spark, d), bind(spark, d, "user_provider"), bind(spark, d, "job_application"), fit, AS_OF)


@query(O.APPLICATION_FACT, "application_fact")
def run_application_fact(spark, d):
    """RUL-32, PRJ-14, JN-11..JN-16."""
    return application_fact(*[bind(spark, d, n) for n in O.FACT_BINDINGS])


@query(f"""{b('job_application')} SELECT state, key AS phone_key, applications, shortlisted, rejected, last_applied, last_applied_age
FROM {O.app_stats('pk', f"(SELECT *, {O.phone_key('seeker_phone')} AS pk FROM b_job_application)")}""")
def seeker_app_stats(spark, d):
    """AGG-06."""
    return seekers.phone_stats(bind(spark, d, "job_application"), stats.as_of_date(AS_OF))


SEEKER_FACTS = f"{with_clause(*O.SEEKER_BINDINGS)}, {O.SEEKER_ROWS}"


@query(f"{SEEKER_FACTS} SELECT state, id, profile_age, last_applied_age, {O.SEEKER_STATUS} AS status FROM sfacts")
def seeker_status(spark, d):
    """RUL-23, JN-19."""
    rows = seekers.with_seeker_facts(seeker_rows(spark, d), bind(spark, d, "job_application"), AS_OF)
    return rows.select("state", "id", "profile_age", "last_applied_age",
                       rules.seeker_status(c("profile_age"), c("last_applied_age")).alias("status"))


@query(f"{SEEKER_FACTS} SELECT state, id, {O.SEEKER_COMPLETION} AS completion, {O.SEEKER_FOLLOW_UP} AS follow_up FROM sfacts")
def seeker_completion(spark, d):
    """RUL-26, RUL-29, JN-17."""
    rows = seekers.seeker_profile(
        *[bind(spark, d, n) for n in ("profile", "user_seeker", "member", "org_seeker", "job_application")], as_of=AS_OF)
    return rows.select("state", "id", c("profile_completion").alias("completion"), "follow_up")


@query(O.SEEKER_PROFILE, "seeker_profile")
def run_seeker_profile(spark, d):
    """RUL-33, PRJ-15, JN-17..JN-20."""
    fit = matching.fit_counts(seeker_rows(spark, d), job_rows(spark, d), "seeker")
    return seekers.seeker_profile(
        *[bind(spark, d, n) for n in ("profile", "user_seeker", "member", "org_seeker", "job_application")],
        fit=fit, as_of=AS_OF)


# ------------------------------------------------------------ labels

@query(f"""{with_clause('job_posting', 'profile')} SELECT DISTINCT value FROM (
  SELECT {O.strip('role')} AS value FROM b_job_posting UNION ALL SELECT {O.strip('title')} FROM b_job_posting
  UNION ALL SELECT {O.strip('job_title')} FROM b_job_posting UNION ALL SELECT {O.strip('role')} FROM b_profile)
WHERE value IS NOT NULL AND value <> ''""")
def distinct_values(spark, d):
    """AGG-09, SET-01."""
    return stats.distinct_values([job_rows(spark, d), seeker_rows(spark, d)], ["role", "title", "job_title"])


def label_columns(col: str, alias: str) -> str:
    names = {"role": "normalized"} | {f: f for f in ROLE_FIELDS[1:]}
    return ", ".join(f"{alias}.{f} AS llm_{col}_{s}" for f, s in names.items())


@query(f"""{with_clause('job_posting', 'taxonomy')} SELECT j.id, {label_columns('role', 'r')}, {label_columns('title', 't')},
  {', '.join(f'CAST(NULL AS VARCHAR) AS llm_unknown_{s}' for s in ('normalized', *ROLE_FIELDS[1:]))}
FROM b_job_posting j LEFT JOIN b_taxonomy r ON r.value = trim(j.role) LEFT JOIN b_taxonomy t ON t.value = trim(j.title)""")
def apply_taxonomy(spark, d):
    """PRJ-18, JN-21; a column the table lacks gets null labels."""
    jobs = job_rows(spark, d).select("id", "role", "title")
    return labels.apply_taxonomy(jobs, ["role", "title", "unknown"], bind(spark, d, "taxonomy")).drop("role", "title")


CONFORMED = ", ".join(
    f"CASE WHEN role = 'Any' THEN 'Any' WHEN role IS NULL THEN NULL {extra} ELSE {f} END AS {f}"
    for f, extra in (("sector", "WHEN sector NOT IN ('Automotive', 'Manufacturing') THEN NULL"), ("collar", ""),
                     *[(f, "") for f in ROLE_FIELDS[3:]])
)


@query(f"{b('taxonomy')} SELECT value, role, {CONFORMED} FROM b_taxonomy")
def conform_labels(spark, d):
    """LBL-05."""
    return labels.conform_labels(bind(spark, d, "taxonomy"))


@query(f"""{with_clause('profile', 'gazetteer')}, p AS (SELECT id, concat_ws(', ', nullif(trim(location_city), ''), nullif(trim(location_state), '')) AS t FROM b_profile)
SELECT p.id, g.state AS llm_location_state, g.district AS llm_location_district FROM p LEFT JOIN b_gazetteer g ON g.text = p.t""")
def label_locations(spark, d):
    """LBL-02, FLT-09, PRJ-20, OPT-05 with a table of known places."""
    places = bind(spark, d, "gazetteer").withColumnRenamed("text", "value")
    rows = labels.label_locations(seeker_rows(spark, d), ["location_city", "location_state"], places)
    return rows.select("id", "llm_location_state", "llm_location_district")


def place_labeller(texts: list[str]) -> list[dict | None]:
    """A stand-in for an external predictor: 'district, state' to its parts."""
    out: list = []
    for text in texts:
        district, _, state = text.partition(", ")
        out.append({"state": state, "district": district if state else 0})
    return out


def no_labeller(texts: list[str]) -> list[dict | None]:
    raise ConnectionError("nothing is left to ask")


@query(f"""{b('profile')}, p AS (SELECT id, concat_ws(', ', nullif(trim(location_city), ''), nullif(trim(location_state), '')) AS t FROM b_profile)
SELECT id, CASE WHEN contains(t, ', ') THEN split_part(t, ', ', 2) ELSE '' END AS llm_location_state,
  CASE WHEN contains(t, ', ') THEN split_part(t, ', ', 1) END AS llm_location_district FROM p""")
def label_batches(spark, d):
    """LBL-01, UDF-02, OPT-08: batches of distinct texts through a labelling function."""
    rows = labels.label_locations(
        seeker_rows(spark, d), ["location_city", "location_state"], place_labeller, check_first=True)
    return rows.select("id", "llm_location_state", "llm_location_district")


@query(f"""{b('profile')}, v AS (SELECT DISTINCT {O.strip('location_city')} AS value FROM b_profile WHERE {O.strip('location_city')} <> '')
SELECT value, CASE WHEN contains(value, ', ') THEN split_part(value, ', ', 2) ELSE '' END AS state,
  CASE WHEN contains(value, ', ') THEN split_part(value, ', ', 1) END AS district FROM v""")
def label_store(spark, d):
    """LBL-01, LBL-03: half of the texts is labelled by a first run, the other half by a second; a third sends nothing."""
    store, values = scratch(spark, "labels"), stats.distinct_values([seeker_rows(spark, d)], ["location_city"])
    half = values.filter(F.crc32("value") % 2 == 0)
    labels.stored_labels(half, place_labeller, ["state", "district"], store)
    labels.stored_labels(values, place_labeller, ["state", "district"], store)
    return labels.stored_labels(values, no_labeller, ["state", "district"], store)


@query(f"""{with_clause('profile', 'taxonomy').replace('WITH ', 'WITH RECURSIVE ', 1)},
v AS (SELECT DISTINCT {O.strip('iti_specialization')} AS value FROM b_profile WHERE {O.strip('iti_specialization')} <> ''),
exact AS (SELECT v.value, t.value AS known FROM v JOIN b_taxonomy t ON lower(t.value) = lower(v.value)),
product AS (SELECT v.value AS a, t.value AS b FROM v, b_taxonomy t WHERE v.value NOT IN (SELECT value FROM exact)), {O.token_set('product')},
near AS (SELECT a AS value, b AS known FROM (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS k
  FROM scored WHERE score >= 0.7::DOUBLE) WHERE k = 1)
SELECT v.value, {', '.join('t.' + f for f in ROLE_FIELDS)} FROM v LEFT JOIN (SELECT * FROM exact UNION ALL SELECT * FROM near) m ON m.value = v.value
LEFT JOIN b_taxonomy t ON t.value = m.known""")
def label_roles_similar(spark, d):
    """LBL-03, LBL-04, FLT-10: distinct trades to the most similar known role."""
    return labels.role_lookup([seeker_rows(spark, d)], ["iti_specialization"], bind(spark, d, "taxonomy"), 0.7)


@query(f"""{with_clause('profile', 'taxonomy')} SELECT p.id, {label_columns('role', 't')}, t.role AS normalised_role
FROM b_profile p LEFT JOIN b_taxonomy t ON lower(t.value) = lower({O.strip('p.role')})""")
def label_roles(spark, d):
    """PRJ-19, LBL-04 on the profiles with a table of known roles."""
    rows = labels.label_roles({"profile": seeker_rows(spark, d).select("id", "role")}, bind(spark, d, "taxonomy"))
    return rows["profile"].drop("role")


FENCE = "chr(96) || chr(96) || chr(96)"
REPLY = f"""SELECT c_custkey, 3 AS size, CASE c_custkey % 6 WHEN 0 THEN '[' || a || ',' || a || ',' || a || ']'
  WHEN 1 THEN {FENCE} || 'json' || chr(10) || '[' || a || ']' || chr(10) || {FENCE}
  WHEN 2 THEN '[' || a || ',5,' || a || ',' || a || ']' WHEN 3 THEN 'no answer' WHEN 4 THEN '{{"state":"x"}}' ELSE '  [{{"state":7}}] ' END AS reply
FROM (SELECT c_custkey, '{{"state":"' || c_mktsegment || '","district":"' || c_name || '"}}' AS a FROM @replies) AS answers"""


@query(f"""WITH r AS ({REPLY.replace("@replies", "customer")}),
i AS (SELECT c_custkey, unnest([0, 1, 2]) AS pos FROM r)
SELECT r.c_custkey, i.pos,
  CASE WHEN r.c_custkey % 6 = 0 OR (r.c_custkey % 6 = 1 AND pos = 0) OR (r.c_custkey % 6 = 2 AND pos <> 1) THEN c_mktsegment END AS state,
  CASE WHEN r.c_custkey % 6 = 0 OR (r.c_custkey % 6 = 1 AND pos = 0) OR (r.c_custkey % 6 = 2 AND pos <> 1) THEN c_name END AS district
FROM r JOIN i ON i.c_custkey = r.c_custkey JOIN customer ON customer.c_custkey = r.c_custkey""")
def label_reply_parse(spark, d):
    """FN-34, FN-35: text replies to one row per position."""
    replies = spark.sql(REPLY.replace("@replies", f"parquet.`{d}/customer.parquet`"))
    rows = labels.reply_answers(replies, ["state", "district"])
    return rows


# ------------------------------------------------------------ runs

COUNTED = {"seekers": "profile", "job_postings": "job_posting", "job_applications": "job_application"}
#: The nine tables of a state; members of the provider side are the seeker side's here.
TABLES = {"profile": "profile", "user_seeker": "user_seeker", "member_seeker": "member", "org_seeker": "org_seeker",
          "job_posting": "job_posting", "job_application": "job_application", "user_provider": "user_provider",
          "org_provider": "org_provider", "member_provider": "member"}
STATE_COUNTS = [(f"{s.lower()}_{n}", s, t) for s in ("KA", "UP") for n, t in TABLES.items()]


@query(with_clause(*TABLES.values()) + " " + " UNION ALL ".join(
    f"SELECT '{n}' AS name, count(*) AS n_rows FROM b_{t} WHERE state = '{s}'" for n, s, t in STATE_COUNTS))
def row_counts(spark, d):
    """AGG-07: nine tables of two states."""
    return runlog.state_counts({n: bind(spark, d, t) for n, t in TABLES.items()})


@query(with_clause(*COUNTED.values()) + " " + " UNION ALL ".join(
    f"SELECT '{n}' AS name, count(*) AS n_rows FROM b_{t}" for n, t in COUNTED.items()))
def table_counts(spark, d):
    """AGG-07 over whole tables."""
    return stats.row_counts({n: bind(spark, d, t) for n, t in COUNTED.items()})


NOW = datetime(2001, 8, 15, 10, 1, 30, tzinfo=timezone.utc)


@query(f"""{with_clause(*TABLES.values())} SELECT '2001-08-15 10:01 UTC' AS run_timestamp, CAST(90 AS INT) AS duration_s,
  {', '.join(f"(SELECT count(*) FROM b_{t} WHERE state = '{s}') AS {n}" for n, s, t in STATE_COUNTS)}, CAST(0 AS BIGINT) AS lost, 'lost | gone' AS errors""")
def run_log(spark, d):
    """SNK-06: eighteen counts; a table that was lost has 0."""
    counts = runlog.state_counts({n: bind(spark, d, t) for n, t in TABLES.items()})
    return runlog.run_log_row(
        counts, [*runlog.state_names(("KA", "UP"), list(TABLES)), "lost"], NOW.replace(minute=0, second=0), NOW, ["lost", "gone"])


@query(f"""{with_clause(*COUNTED.values())} SELECT '2001-08-15 10:01 UTC' AS run_timestamp,
  {', '.join(f"(SELECT count(*) FROM b_{t} WHERE state = '{s}') AS {s.lower()}_{n}" for s in ('KA', 'UP') for n, t in COUNTED.items())}""")
def run_history(spark, d):
    """SNK-08."""
    return runlog.history_row({n: bind(spark, d, t) for n, t in COUNTED.items()}, ["KA", "UP"], NOW)


@query(f"""{with_clause('job_application')} SELECT DISTINCT state, job_id FROM b_job_application a WHERE NOT EXISTS
  (SELECT 1 FROM b_job_application x WHERE x.state = a.state AND x.job_id = a.job_id AND x.status = 'closed')""")
def pending_outputs(spark, d):
    """SNK-07, SET-04: expected keys no finished row covers."""
    apps = bind(spark, d, "job_application")
    manifest = apps.select("state", "job_id", (c("status") == "closed").alias("done"))
    return stats.pending_outputs(apps.select("state", "job_id").distinct(), manifest, ["state", "job_id"])


@query(O.WHOLE_RUN)
def whole_run(spark, d):
    """Raw documents to the job report: flatten, label, flag, match, report. Tables on the way hold what later steps read."""
    raw = {
        "profile": bind(spark, d, "raw_profile").withColumn("user_id", F.concat(F.lit("U"), c("id"))),
        "job_posting": bind(spark, d, "raw_posting").withColumns({
            "status": F.lit("open"), "organization_name": c("title"), "organization_id": c("id"),
            "created_by": F.concat(F.lit("P"), c("id")), "created_at": F.lit("2001-08-01"),
            "location": F.lit("{}"),
        }),
    }
    places = bind(spark, d, "gazetteer").withColumnRenamed("text", "value")
    flat = {t: stage(df) for t, df in clean(raw, OPEN_ROLES_FIELDS).items()}
    labelled = {t: stage(df) for t, df in enrich(flat, places, bind(spark, d, "taxonomy")).items()}
    tables = flag_all(labelled, deny_table(spark, d), DOMAINS)
    fit = matching.fit_counts(tables["profile"], tables["job_posting"], "job")
    return roles.open_roles(
        tables["job_posting"], bind(spark, d, "user_provider"), bind(spark, d, "job_application"), fit, AS_OF)
