"""DuckDB SQL that restates each query, written from the rules and not from the Spark code."""

from __future__ import annotations

from worklink.constants import EDUCATION_LEVELS
from worklink.workload.bindings import AS_OF, with_clause
from worklink.workload.oracle_json import flatten_sql, phone

DAY = f"DATE '{AS_OF}'"
STRIP = r"'^\s+|\s+$', '', 'g'"
FORMATS = "['%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d']"


def strip(c: str) -> str:
    return f"regexp_replace({c}, {STRIP})"


def safe(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), '')"


def digits(c: str) -> str:
    return f"coalesce(regexp_replace({c}, '[^0-9]', '', 'g'), '')"


def stamp(c: str) -> str:
    return f"try_strptime({strip(c)}, {FORMATS})"


def fmt(ts: str) -> str:
    return f"coalesce(strftime({ts}, '%-m/%-d/%Y'), '')"


def age(ts: str) -> str:
    return f"CAST(date_diff('day', CAST({ts} AS DATE), {DAY}) AS INT)"


def number(c: str) -> str:
    pattern = r"'\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*'"
    return f"CASE WHEN regexp_full_match({c}, {pattern}) THEN try_cast({c} AS DOUBLE) END"


def to_num(c: str) -> str:
    n = number(c)
    return (
        f"coalesce(CASE WHEN {n} = floor({n}) THEN CAST(CAST({n} AS BIGINT) AS VARCHAR) "
        f"ELSE CAST({n} AS VARCHAR) END, {c}, '')"
    )


def salary(low: str, high: str) -> str:
    def whole(c: str) -> str:
        return f"CAST(CAST(trunc({number(c)}) AS BIGINT) AS VARCHAR)"

    has_low, has_high = f"{safe(low)} NOT IN ('', 'nan')", f"{safe(high)} NOT IN ('', 'nan')"
    return (
        f"coalesce(CASE WHEN {has_low} AND {has_high} THEN {whole(low)} || ' - ' || {whole(high)} "
        f"WHEN {has_low} THEN {whole(low)} WHEN {has_high} THEN {whole(high)} END, '')"
    )


def edu_level(c: str) -> str:
    exact = " ".join(f"WHEN '{k}' THEN {v}" for k, v in EDUCATION_LEVELS.items())
    inside = " ".join(f"WHEN contains(p, '{k}') THEN {v}" for k, v in EDUCATION_LEVELS.items())
    one = f"CASE p {exact} ELSE CASE {inside} END END"
    return (
        f"list_max(list_transform(list_transform(string_split(lower({c}), '|'), "
        f"lambda x: trim(x)), lambda p: {one}))"
    )


def filled(*cols: str) -> str:
    return "(" + " + ".join(f"CASE WHEN {safe(c)} <> '' THEN 1 ELSE 0 END" for c in cols) + ")"


def denied_phone(d: str) -> str:
    """Digits found in the denylist, as they are or without a country prefix."""
    rests = " ".join(
        f"OR (starts_with({d}, '{p}') AND length({d}) > {len(p)} AND "
        f"(dl.value = substr({d}, {len(p) + 1}) OR dl.value = ltrim(substr({d}, {len(p) + 1}), '0')))"
        for p in ("91", "091", "0")
    )
    return f"EXISTS (SELECT 1 FROM deny dl WHERE dl.kind = 'phone' AND (dl.value = {d} {rests}))"


def test_phone(c: str) -> str:
    d = digits(c)
    return (
        f"({d} <> '' AND ({denied_phone(d)} OR length(replace({d}, substr({d}, 1, 1), '')) = 0 "
        f"OR length({d}) < 8 OR length({d}) > 13))"
    )


def test_email(c: str, domains: str = "('internal.example')") -> str:
    e = f"coalesce(lower({strip(c)}), '')"
    return (
        f"(contains({e}, '@') AND (EXISTS (SELECT 1 FROM deny dl WHERE dl.kind = 'email' AND dl.value = {e}) "
        f"OR string_split({e}, '@')[-1] IN {domains} "
        f"OR regexp_matches({e}, '\\+(test|demo|trial|sample)[0-9]*@')))"
    )


def test_org(c: str) -> str:
    n = f"coalesce({strip(c)}, '')"
    return (
        f"({n} <> '' AND (EXISTS (SELECT 1 FROM deny dl WHERE dl.kind = 'org' AND lower(dl.value) = lower({n})) "
        f"OR regexp_matches(lower({n}), '\\b(test|demo|trial|sample|dummy|fake|xyz)\\b')))"
    )


DENY = f"""deny AS (SELECT DISTINCT
  CASE WHEN contains(v, '@') THEN 'email' WHEN regexp_matches(v, '[0-9]') THEN 'phone' ELSE 'org' END AS kind,
  CASE WHEN contains(v, '@') THEN lower(v) WHEN regexp_matches(v, '[0-9]') THEN {digits('v')} ELSE v END AS value
  FROM (SELECT {strip('value')} AS v FROM %s) WHERE v <> '')"""


def deny(source: str = "b_denylist") -> str:
    return DENY % source


def flag_sql(binding: str, rule: str, cols: str) -> str:
    return (
        f"{with_clause(binding, 'denylist')}, {deny()}\n"
        f"SELECT {cols}, CAST({rule} AS INT) AS test_flag FROM b_{binding}"
    )


ORG_RULE = f"{test_phone('contact_phone')} OR {test_email('contact_email')} OR {test_org('name')}"

# ---------------------------------------------------------------- matching

MATCH_INPUT = f"""
sk AS (SELECT * FROM (SELECT *, coalesce(nullif({strip('iti_specialization')}, ''), nullif({strip('role')}, '')) AS sk_key,
    {edu_level('highest_qualification')} AS sk_level, {number('monthly_in_hand_preferred')} AS sk_salary
  FROM b_profile WHERE test_flag IS NULL OR trim(test_flag) = '' OR try_cast(test_flag AS DOUBLE) = 0) WHERE sk_key IS NOT NULL),
pr AS (SELECT * FROM (SELECT *, coalesce(nullif({strip('llm_title_normalized')}, ''), nullif({strip('job_title')}, ''),
    nullif({strip('title')}, ''), nullif({strip('role')}, '')) AS pr_role,
    {edu_level('min_education_level')} AS pr_level, {number('min_monthly_in_hand')} AS pr_min,
    {number('max_monthly_in_hand')} AS pr_max
  FROM b_job_posting WHERE lower({strip('status')}) = 'open' AND coalesce(try_cast(test_flag AS DOUBLE), 0) = 0)
  WHERE pr_role IS NOT NULL)"""


def token_set(pairs: str) -> str:
    """CTEs that score the rows (a, b) of a relation; the result is `scored`."""
    return rf"""
tok AS (SELECT a, b, list_sort(list_distinct(list_filter(regexp_split_to_array(a, '\s+'), lambda x: x <> ''))) AS ta,
    list_sort(list_distinct(list_filter(regexp_split_to_array(b, '\s+'), lambda x: x <> ''))) AS tb FROM {pairs}),
cut AS (SELECT a, b, len(ta) AS na, len(tb) AS nb, list_filter(ta, lambda x: list_contains(tb, x)) AS ti,
    array_to_string(list_filter(ta, lambda x: NOT list_contains(tb, x)), ' ') AS sa,
    array_to_string(list_filter(tb, lambda x: NOT list_contains(ta, x)), ' ') AS sb FROM tok),
texts AS (SELECT DISTINCT sa, sb FROM cut),
dp AS (SELECT sa, sb, 0 AS i, list_transform(range(length(sb) + 1), lambda x: 0) AS line FROM texts
  UNION ALL
  SELECT sa, sb, i + 1, list_concat([0], list_transform(range(1, length(sb) + 1), lambda j: greatest(line[j + 1],
      CASE WHEN contains(substr(sb, 1, j), substr(sa, i + 1, 1))
           THEN line[j - strpos(reverse(substr(sb, 1, j)), substr(sa, i + 1, 1)) + 1] + 1 ELSE 0 END)))
  FROM dp WHERE i < length(sa)),
lcs AS (SELECT sa, sb, line[length(sb) + 1] AS n FROM dp WHERE i = length(sa)),
len_all AS (SELECT cut.a, cut.b, cut.na, cut.nb, lcs.n, length(array_to_string(ti, ' ')) AS s, CASE WHEN len(ti) > 0 THEN 1 ELSE 0 END AS sep,
    length(cut.sa) AS la, length(cut.sb) AS lb FROM cut JOIN lcs ON cut.sa = lcs.sa AND cut.sb = lcs.sb),
ratio AS (SELECT a, b, CASE WHEN na = 0 OR nb = 0 THEN CAST(0 AS DOUBLE)
    WHEN s > 0 AND (la = 0 OR lb = 0) THEN CAST(100 AS DOUBLE)
    WHEN s = 0 THEN 100::DOUBLE - 100::DOUBLE * (la + lb - 2 * n) / (la + lb)
    ELSE greatest(100::DOUBLE - 100::DOUBLE * (la + lb - 2 * n) / (2 * (s + sep) + la + lb),
                  100::DOUBLE - 100::DOUBLE * (sep + la) / (2 * s + sep + la),
                  100::DOUBLE - 100::DOUBLE * (sep + lb) / (2 * s + sep + lb)) END AS r FROM len_all),
scored AS (SELECT a, b, CASE WHEN lower(a) = lower(b) THEN CAST(1 AS DOUBLE) ELSE r / 100::DOUBLE END AS score FROM ratio)"""


PAIRS = f"""
parts AS (SELECT sk_key, unnest(l) AS trade, generate_subscripts(l, 1) AS pos FROM
  (SELECT DISTINCT sk_key, list_filter(list_transform(string_split(sk_key, '|'), lambda x: trim(x)), lambda x: x <> '') AS l FROM sk)),
product AS (SELECT a, b FROM (SELECT DISTINCT trade AS a FROM parts), (SELECT DISTINCT pr_role AS b FROM pr)),
{token_set('product')},
pairs AS (SELECT sk_key, pr_role, round(score, 4) AS role_score, trade AS best_trade FROM
  (SELECT sk_key, b AS pr_role, score, trade, row_number() OVER (PARTITION BY sk_key, b ORDER BY score DESC, pos) AS k
   FROM parts JOIN scored ON trade = a WHERE score >= 0.30::DOUBLE) WHERE k = 1)"""


def fold(c: str) -> str:
    return f"lower(coalesce({strip(c)}, ''))"


def location_score(ss: str, ps: str, sd: str, pd: str) -> str:
    ss, ps, sd, pd = map(fold, (ss, ps, sd, pd))
    return (
        f"CAST(CASE WHEN {ss} = '' OR {ps} = '' THEN NULL WHEN NOT contains({ss}, {ps}) AND NOT contains({ps}, {ss}) THEN 0 "
        f"WHEN {sd} = '' OR {pd} = '' THEN 0.6 WHEN contains({sd}, {pd}) OR contains({pd}, {sd}) THEN 1 ELSE 0.6 END AS DOUBLE)"
    )


def salary_score(want: str, low: str, high: str) -> str:
    lo0 = f"CASE WHEN {low} IS NOT NULL THEN {low} ELSE {high} * 0.8::DOUBLE END"
    hi0 = f"CASE WHEN {high} IS NOT NULL THEN {high} ELSE {low} * 1.2::DOUBLE END"
    lo, hi = f"least({lo0}, {hi0})", f"greatest({lo0}, {hi0})"
    buf = f"greatest(({hi} - {lo}) * 0.2::DOUBLE, 2000::DOUBLE)"
    return (
        f"CAST(CASE WHEN {want} IS NULL OR ({low} IS NULL AND {high} IS NULL) THEN NULL "
        f"WHEN {want} >= {lo} AND {want} <= {hi} THEN 1 "
        f"WHEN {want} >= {lo} - {buf} AND {want} <= {hi} + {buf} THEN 0.5 ELSE 0 END AS DOUBLE)"
    )


def education_score(have: str, need: str) -> str:
    return (
        f"CAST(CASE WHEN {have} IS NULL OR {need} IS NULL THEN NULL WHEN {have} >= {need} THEN 1 "
        f"WHEN {have} = {need} - 1 THEN 0.5 ELSE 0 END AS DOUBLE)"
    )


def confidence(r: str, l: str, s: str, e: str) -> str:
    weights = {r: "0.4", l: "0.3", s: "0.2", e: "0.1"}
    top = " + ".join(f"coalesce({c} * {w}::DOUBLE, 0::DOUBLE)" for c, w in weights.items())
    total = " + ".join(f"CASE WHEN {c} IS NULL THEN 0::DOUBLE ELSE {w}::DOUBLE END" for c, w in weights.items())
    return f"CASE WHEN {total} > 0 THEN ({top}) / ({total}) ELSE 0::DOUBLE END"


MATCHES = f"""
cand AS (SELECT sk.state, sk.user_id AS seeker_id, pr.id AS provider_job_id, role_score, best_trade,
    {location_score('sk.llm_location_state', 'pr.llm_location_state', 'sk.llm_location_district', 'pr.llm_location_district')} AS location_score,
    {salary_score('sk_salary', 'pr_min', 'pr_max')} AS salary_score,
    {education_score('sk_level', 'pr_level')} AS education_score
  FROM sk JOIN pairs ON sk.sk_key = pairs.sk_key JOIN pr ON pr.pr_role = pairs.pr_role AND pr.state = sk.state),
conf AS (SELECT *, {confidence('role_score', 'location_score', 'salary_score', 'education_score')} AS confidence FROM cand),
matches AS (SELECT *, CASE WHEN role_score >= 0.5 AND coalesce(location_score, -1) >= 0.5 THEN 'Right Fit'
    WHEN role_score >= 0.5 THEN 'Partial Fit' END AS match_category FROM conf WHERE confidence >= 0.4::DOUBLE AND role_score >= 0.5)"""

MATCH_WITH = f"{with_clause('profile', 'job_posting').replace('WITH ', 'WITH RECURSIVE ', 1)}, {MATCH_INPUT}, {PAIRS}, {MATCHES}"


def match_with(*bindings: str) -> str:
    names = dict.fromkeys(("profile", "job_posting", *bindings))
    return f"{with_clause(*names).replace('WITH ', 'WITH RECURSIVE ', 1)}, {MATCH_INPUT}, {PAIRS}, {MATCHES}"


def first_row(source: str, key: str, cols: list[str], order: list[str]) -> str:
    """Keep-first per (state, key)."""
    by = ", ".join(f"{c} NULLS LAST" for c in order)
    return (
        f"(SELECT state, {key}, {', '.join(cols)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY state, {key} ORDER BY {by}) AS rn FROM {source}) WHERE rn = 1)"
    )


MEMBER_ORG = f"""(SELECT m.state, m.user_id, f.organization_id AS org_id, o.name AS org_name FROM
  (SELECT DISTINCT state, user_id FROM b_member WHERE user_id IS NOT NULL) m
  LEFT JOIN {first_row('(SELECT * FROM b_member WHERE user_id IS NOT NULL AND organization_id IS NOT NULL)', 'user_id',
                       ['organization_id'], ['created_at', 'organization_id'])} f ON f.state = m.state AND f.user_id = m.user_id
  LEFT JOIN (SELECT state, id, min(name) AS name FROM b_org_seeker GROUP BY state, id) o ON o.state = m.state AND o.id = f.organization_id)"""

FIRST_EMAIL = first_row('b_user_seeker', 'id', ['email'], ['created_at', 'email'])

# rounds the exact value; the fraction alone is an exact difference
PCT = "floor({0} * 100) + round_even(({0} * 100 - floor({0} * 100)) * 10, 0) / 10"

MATCH_REPORT = f"""{match_with('user_seeker', 'member', 'org_seeker', 'user_provider')}
SELECT m.state, m.seeker_id, m.provider_job_id, match_category, round_even(confidence * 100 * 10, 0) / 10 AS "confidence_score_%",
  CASE WHEN confidence >= 0.8::DOUBLE THEN 'High' WHEN confidence >= 0.6::DOUBLE THEN 'Medium' WHEN confidence >= 0.4::DOUBLE THEN 'Low' ELSE 'Very Low' END AS confidence_label,
  {PCT.format('role_score')} AS "role_match_%", {PCT.format('location_score')} AS "location_match_%",
  {PCT.format('salary_score')} AS "salary_match_%", {PCT.format('education_score')} AS "education_match_%",
  {safe(strip('pr.role'))} AS job_role, {safe(strip('pr.title'))} AS job_title, pr.pr_role AS job_normalised_title,
  {safe(strip('sk.name'))} AS seeker_name, {safe(strip('sk.phone'))} AS seeker_phone, {safe('u.email')} AS seeker_email,
  best_trade AS seeker_matched_trade, {safe(strip('sk.iti_specialization'))} AS seeker_iti_full, {safe(strip('sk.role'))} AS seeker_role,
  {safe(strip('sk.llm_location_district'))} AS seeker_location_district, {safe(strip('sk.llm_location_state'))} AS seeker_location_state,
  {safe('sk.monthly_in_hand_preferred')} AS seeker_expected_salary, {safe('sk.highest_qualification')} AS seeker_qualification,
  {safe('mo.org_id')} AS seeker_org_id, {safe('mo.org_name')} AS seeker_org_name,
  {safe('pr.organization_name')} AS provider_org_name, {safe('pr.organization_id')} AS provider_org_id,
  {safe('pr.llm_location_district')} AS job_location_district, {safe('pr.llm_location_state')} AS job_location_state,
  {safe('pr.min_monthly_in_hand')} AS job_salary_min, {safe('pr.max_monthly_in_hand')} AS job_salary_max,
  {safe('pr.min_education_level')} AS job_min_education, {safe('pr.positions')} AS job_openings,
  {safe('p.name')} AS provider_contact_name, {safe('p.phone_number')} AS provider_contact_phone, {safe('p.email')} AS provider_contact_email
FROM matches m JOIN sk ON sk.state = m.state AND sk.user_id = m.seeker_id
  JOIN pr ON pr.state = m.state AND pr.id = m.provider_job_id
  LEFT JOIN {FIRST_EMAIL} u ON u.state = m.state AND u.id = m.seeker_id
  LEFT JOIN {MEMBER_ORG} mo ON mo.state = m.state AND mo.user_id = m.seeker_id
  LEFT JOIN b_user_provider p ON p.state = m.state AND p.id = pr.created_by"""


def fit_sql(key: str) -> str:
    return f"""(SELECT state, {key}, count(*) FILTER (match_category = 'Right Fit') AS right_fit,
    count(*) FILTER (match_category = 'Partial Fit') AS partial_fit FROM matches GROUP BY state, {key})"""


# ---------------------------------------------------------------- reports

def app_stats(key: str, source: str) -> str:
    ts = stamp("applied_at")

    def oldest(value: str) -> str:
        return age(f"min({ts}) FILTER (lower({safe('status')}) = '{value}')")

    return f"""(SELECT state, {key} AS key, count(*) AS applications,
    count(*) FILTER (lower({safe('application_status')}) = 'shortlisted') AS shortlisted,
    count(*) FILTER (lower({safe('application_status')}) = 'rejected') AS rejected,
    max({ts}) AS last_applied, {age(f'max({ts})')} AS last_applied_age,
    {oldest('open')} AS application_pending_from, {oldest('closed')} AS shortlisted_age, {oldest('archived')} AS rejected_age
  FROM {source} WHERE {key} IS NOT NULL GROUP BY state, {key})"""


OPEN_ROWS = f"""
j AS (SELECT b.*, u.name AS u_name, u.phone_number AS u_phone, u.email AS u_email,
    {salary('min_monthly_in_hand', 'max_monthly_in_hand')} AS salary, {stamp('b.created_at')} AS created_ts
  FROM b_job_posting b LEFT JOIN b_user_provider u ON u.state = b.state AND u.id = b.created_by
  WHERE lower({strip('b.status')}) = 'open'),
stats AS (SELECT * FROM {app_stats('job_id', 'b_job_application')}),
facts AS (SELECT j.*, coalesce(s.applications, 0) AS n_apps, coalesce(s.shortlisted, 0) AS n_short, coalesce(s.rejected, 0) AS n_rej,
    s.last_applied, s.application_pending_from, s.shortlisted_age, s.rejected_age, {age('created_ts')} AS job_age,
    count(*) OVER (PARTITION BY j.state, {safe('organization_name')}, {safe('role')}, {safe('positions')}, salary,
      {safe('job_description')}, {safe('u_name')}, {safe('u_phone')}) AS copies,
    coalesce(CAST(trunc({number('positions')}) AS BIGINT), 0) AS n_open,
    least(s.shortlisted_age, s.rejected_age) AS done_age
  FROM j LEFT JOIN stats s ON s.state = j.state AND s.key = j.id)"""

JOB_STATUS = """CASE WHEN job_age <= 7 THEN 'New'
  WHEN n_apps > 0 AND n_open > 0 AND n_short + n_rej >= n_open THEN 'Satisfied'
  WHEN n_apps > 0 AND n_short + n_rej > 0 AND done_age IS NOT NULL AND done_age <= 30 THEN 'Active'
  WHEN n_apps > 0 AND n_short + n_rej > 0 AND done_age >= 31 AND done_age <= 90 AND n_short + n_rej < n_open THEN 'At Risk'
  WHEN job_age > 7 AND job_age <= 30 AND n_apps = 0 THEN 'At Risk' ELSE 'Inactive' END"""

U_PHONE = f"coalesce({phone('u_phone')}, '')"
JOB_COMPLETION = (
    "round(" + filled("organization_name", "role", "positions", "salary", "job_description",
                      "u_name", U_PHONE, "u_email") + " / 8, 4)"
)
PROVIDER_ACTION = """concat_ws('; ', CASE WHEN n_apps > 0 AND n_short = 0 AND n_rej = 0 THEN 'Nudge job providers' END,
  CASE WHEN job_age >= 30 AND n_short = 0 AND n_rej = 0 THEN 'Check job freshness' END)"""
JOB_FOLLOW_UP = f"""concat_ws(', ',
  CASE WHEN {safe('organization_name')} = '' OR {safe('role')} = '' OR {safe('positions')} = '' THEN 'Update Location' END,
  CASE WHEN salary = '' THEN 'Update Role' END,
  CASE WHEN {safe('job_description')} = '' THEN 'Update Openings' END,
  CASE WHEN {safe('u_name')} = '' THEN 'Update Salary' END,
  CASE WHEN {safe('u_email')} = '' OR {safe('organization_id')} = '' OR {safe('organization_name')} = '' THEN 'Update Contact Details' END,
  CASE WHEN {number('positions')} = floor({number('positions')}) AND n_short > n_rej + {number('positions')} THEN 'Shortlist / Reject Applications' END)"""

OPEN_BINDINGS = ("job_posting", "user_provider", "job_application")


def open_roles_sql(fit: bool) -> str:
    if fit:
        head, join = match_with(*OPEN_BINDINGS), f"LEFT JOIN {fit_sql('provider_job_id')} f ON f.state = x.state AND f.provider_job_id = x.id"
        right, partial = "coalesce(f.right_fit, 0)", "coalesce(f.partial_fit, 0)"
    else:
        head, join, right, partial = with_clause(*OPEN_BINDINGS), "", "CAST(0 AS BIGINT)", "CAST(0 AS BIGINT)"
    return f"""{head}, {OPEN_ROWS}
SELECT x.state, id, {safe('location')} AS location, {safe('organization_name')} AS organization_name, {safe('role')} AS role,
  {to_num('positions')} AS openings, salary, {safe('job_description')} AS job_description, {safe('u_name')} AS contact_name,
  {U_PHONE} AS contact_number, {safe('u_email')} AS contact_email, {safe('organization_id')} AS organisation_id,
  {safe('organization_name')} AS organisation_name, {fmt('created_ts')} AS job_post_date, n_apps AS applications,
  n_short AS shortlisted, n_rej AS rejected, {to_num('positions')} AS current_openings,
  CASE WHEN copies > 1 THEN 'Yes' ELSE 'No' END AS duplicate, {safe('llm_role_sector')} AS job_sector, job_age,
  {right} AS right_fit_seekers, {fmt('last_applied')} AS last_application_date, application_pending_from, shortlisted_age,
  rejected_age, {PROVIDER_ACTION} AS provider_action, '' AS seeker_action, CASE WHEN {safe('id')} <> '' THEN 'Jobs' ELSE '' END AS request_type,
  {JOB_COMPLETION} AS profile_completion, {JOB_FOLLOW_UP} AS follow_up, {JOB_STATUS} AS status,
  {safe('llm_role_normalized')} AS normalised_role, {safe('llm_location_state')} AS location_state,
  {safe('llm_location_district')} AS location_district, {to_num('test_flag')} AS test, {partial} AS partial_fit_seekers,
  {safe('title')} AS title, {safe('llm_title_normalized')} AS normalised_title, {safe('llm_title_sector')} AS normalised_title_sector
FROM facts x {join}"""


FACT_BINDINGS = ("job_application", "job_posting", "org_provider", "user_provider", "user_seeker",
                 "profile", "member", "org_seeker")

APPLICATION_FACT = f"""{with_clause(*FACT_BINDINGS)}
SELECT a.state AS data_state, {', '.join(f'{safe("a." + c)} AS {c}' for c in (
    'id', 'job_id', 'transaction_id', 'status', 'application_status', 'user_name', 'user_id', 'location', 'contact', 'metadata'))},
  {fmt(stamp('a.applied_at'))} AS applied_at, {fmt(stamp('a.updated_at'))} AS updated_at, {safe('a.seeker_phone')} AS phone,
  coalesce({phone('a.seeker_phone')}, '') AS formatted_phone, {safe('j.organization_name')} AS company_name,
  {safe('a.location')} AS location_copy, {to_num('a.test_flag')} AS test_flag, {safe('up.phone_number')} AS user_phone,
  {safe('up.email')} AS user_email, {safe('j.llm_location_district')} AS user_district, {safe('j.llm_location_state')} AS user_state,
  {safe('a.job_role')} AS job_role, {safe('pf.iti_institute')} AS institution_name, '' AS institution_id,
  {safe('op.contact_person')} AS contact_name, {safe('op.contact_phone')} AS contact_number, {safe('op.contact_email')} AS contact_email,
  {safe('mo.org_id')} AS seeker_org_id, {safe('mo.org_name')} AS seeker_org_name, '' AS request_type, {safe('a.job_title')} AS title,
  {safe('a.llm_job_title_normalized')} AS normalised_title, {safe('a.llm_job_title_sector')} AS normalised_title_sector,
  {safe('a.seeker_email')} AS seeker_email, {safe('a.seeker_age')} AS seeker_age,
  {safe('a.seeker_iti_specialization')} AS seeker_iti_specialization, {safe('a.seeker_highest_qualification')} AS seeker_highest_qualification,
  {safe('pf.llm_location_district')} AS llm_location_district, {safe('pf.llm_location_state')} AS llm_location_state,
  {safe('us.phone_number')} AS seeker_user_phone, {safe('us.email')} AS seeker_user_email
FROM b_job_application a
  LEFT JOIN b_job_posting j ON j.state = a.state AND j.id = a.job_id
  LEFT JOIN b_org_provider op ON op.state = a.state AND op.id = j.organization_id
  LEFT JOIN b_user_provider up ON up.state = a.state AND up.id = j.created_by
  LEFT JOIN {first_row('b_user_seeker', 'id', ['phone_number', 'email'], ['created_at', 'phone_number', 'email'])} us ON us.state = a.state AND us.id = a.user_id
  LEFT JOIN b_profile pf ON pf.state = a.state AND pf.user_id = a.user_id
  LEFT JOIN b_profile bridge ON bridge.state = a.state AND bridge.id = a.user_id
  LEFT JOIN {MEMBER_ORG} mo ON mo.state = a.state AND mo.user_id = bridge.user_id"""

def phone_key(c: str) -> str:
    without = f"regexp_replace({c}, '\\.0$', '')"
    return f"nullif({strip(without)}, '')"


SEEKER_BINDINGS = ("profile", "user_seeker", "member", "org_seeker", "job_application")

SEEKER_ROWS = f"""
pstats AS (SELECT * FROM {app_stats('pk', f"(SELECT *, {phone_key('seeker_phone')} AS pk FROM b_job_application)")}),
sfacts AS (SELECT p.*, coalesce(s.applications, 0) AS n_apps, coalesce(s.shortlisted, 0) AS n_short, coalesce(s.rejected, 0) AS n_rej,
    s.last_applied, s.last_applied_age, {stamp('p.created_at')} AS created_ts,
    coalesce({age(stamp('p.created_at'))}, 0) AS profile_age, u.email, mo.org_id, mo.org_name
  FROM b_profile p LEFT JOIN pstats s ON s.state = p.state AND s.key = {phone_key('p.phone')}
    LEFT JOIN {FIRST_EMAIL} u ON u.state = p.state AND u.id = p.user_id
    LEFT JOIN {MEMBER_ORG} mo ON mo.state = p.state AND mo.user_id = p.user_id)"""

SEEKER_STATUS = """CASE WHEN profile_age <= 7 THEN 'New' WHEN last_applied_age <= 30 THEN 'Active'
  WHEN last_applied_age BETWEEN 31 AND 90 THEN 'At Risk' ELSE 'Inactive' END"""
SEEKER_COMPLETION = (
    "round(" + filled("name", "current_location", "llm_location_district", "llm_location_state", "email", "phone",
                      "iti_specialization", "iti_institute", "role", to_num("age"),
                      to_num("monthly_in_hand_preferred"), "highest_qualification") + " / 13, 4)"
)
SEEKER_FOLLOW_UP = f"""concat_ws(', ', CASE WHEN {safe('user_id')} = '' THEN 'Update Name' END, 'Update Location',
  CASE WHEN {safe('phone')} = '' AND {safe('iti_specialization')} = '' THEN 'Update Contact Details' END,
  CASE WHEN {to_num('age')} = '' THEN 'Update Role' END)"""


def gps(axis: str) -> str:
    ok = "CASE WHEN json_valid(metadata) THEN metadata END"
    return to_num(f"json_extract_string({ok}, '$.whoIAm.locationData.gps.{axis}')")


SEEKER_PROFILE = f"""{match_with(*SEEKER_BINDINGS)}, {SEEKER_ROWS}
SELECT x.state, id, user_id, {safe('name')} AS name, {safe('current_location')} AS location, {gps('lng')} AS longitude, {gps('lat')} AS latitude,
  {safe('llm_location_district')} AS location_district, {safe('llm_location_state')} AS location_state, '' AS pincode,
  {safe('email')} AS email, {safe('phone')} AS phone, {safe('iti_specialization')} AS trade, {safe('iti_institute')} AS institution_name,
  {safe('role')} AS role, {to_num('test_flag')} AS test, {to_num('age')} AS age, {to_num('monthly_in_hand_preferred')} AS expected_salary,
  {safe('highest_qualification')} AS qualification, {safe('org_id')} AS org_id, {safe('org_name')} AS org_name,
  'Kaam Ki Baat' AS recommended_action, n_apps AS applications, n_short AS shortlisted, n_rej AS rejected,
  {SEEKER_COMPLETION} AS profile_completion, {SEEKER_FOLLOW_UP} AS follow_up, {fmt('created_ts')} AS created_on, profile_age,
  last_applied_age, {fmt('last_applied')} AS last_application_date, {SEEKER_STATUS} AS status,
  coalesce(f.partial_fit, 0) AS partial_fit, coalesce(f.right_fit, 0) AS direct_fit,
  {safe('llm_role_normalized')} AS normalised_role, {safe('llm_role_sector')} AS job_sector
FROM sfacts x LEFT JOIN {fit_sql('seeker_id')} f ON f.state = x.state AND f.seeker_id = x.user_id"""

# ---------------------------------------------------------------- the whole run


def place_text(cols: list[str]) -> str:
    return "concat_ws(', ', " + ", ".join(f"nullif({strip(c)}, '')" for c in cols) + ")"


RUN_BINDINGS = ("raw_profile", "raw_posting", "gazetteer", "taxonomy", "denylist", "user_provider", "job_application")
RUN_PLACES = {
    "profile": ["location_city", "location_state", "location_address", "location_country", "current_location", "hometown"],
    "posting": ["provider_location_city", "provider_location_state", "provider_location_address", "provider_location_country"],
}


def role_join(col: str) -> str:
    return f"LEFT JOIN b_taxonomy x_{col} ON lower({strip(f'x_{col}.value')}) = lower({strip(f'f.{col}')})"


RUN_INPUT = f"""{with_clause(*RUN_BINDINGS).replace('WITH ', 'WITH RECURSIVE ', 1)}, {deny()},
f_profile AS (SELECT *, {place_text(RUN_PLACES['profile'])} AS place FROM ({flatten_sql('profile', 'raw_profile', ['state', 'id'])})),
b_profile AS (SELECT f.*, 'U' || f.id AS user_id, g.state AS llm_location_state, g.district AS llm_location_district,
    CAST(CAST({test_phone('phone')} AS INT) AS VARCHAR) AS test_flag
  FROM f_profile f LEFT JOIN b_gazetteer g ON lower(g.text) = lower(f.place)),
f_posting AS (SELECT *, {place_text(RUN_PLACES['posting'])} AS place
  FROM ({flatten_sql('job_posting', 'raw_posting', ['state', 'id', 'title', 'description'])})),
b_job_posting AS (SELECT f.state, f.id, f.title, f.role, coalesce(x_job_title.role, f.job_title) AS job_title, f.job_description, f.positions,
    f.min_monthly_in_hand, f.max_monthly_in_hand, f.min_education_level, 'open' AS status, f.title AS organization_name,
    f.id AS organization_id, 'P' || f.id AS created_by, '2001-08-01' AS created_at, '{{}}' AS location,
    g.state AS llm_location_state, g.district AS llm_location_district, x_title.role AS llm_title_normalized,
    x_title.sector AS llm_title_sector, x_role.role AS llm_role_normalized, x_role.sector AS llm_role_sector,
    CAST(CAST({test_org('f.title')} AS INT) AS VARCHAR) AS test_flag
  FROM f_posting f LEFT JOIN b_gazetteer g ON lower(g.text) = lower(f.place)
    {role_join('role')} {role_join('title')} {role_join('job_title')})"""

WHOLE_RUN = f"{RUN_INPUT}, {MATCH_INPUT}, {PAIRS}, {MATCHES}" + open_roles_sql(True).removeprefix(match_with(*OPEN_BINDINGS))
