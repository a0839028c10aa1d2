"""Logical tables derived from the driver's tables.

Each binding is one SQL text that Spark and DuckDB both accept, so a query and
its SQL restatement share their input and nothing else. `@name` is a table of
the driver, `#name` another binding.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from worklink.operators.fieldmap import FIELD_MAPS

AS_OF = "2001-08-15"

ADJECTIVES = "red,blue,small,large,new,old,hot,cold"
NOUNS = "widget,bolt,gear,rod,plate,ring,anvil,gizmo"
QUALIFICATIONS = "8th,10th pass,12th,ITI,Diploma|12th,Graduate,post graduate degree,MBA,"
MIN_EDUCATION = "10th,12th pass,iti,Diploma,graduate,8th pass|ITI,,unknown"


def cycle(words: str, index: str) -> str:
    n = words.count(",") + 1
    return f"split_part('{words}', ',', CAST(({index}) % {n} AS INT) + 1)"


def step(index: str, n: int) -> str:
    return f"CAST(floor({index} / {n}) AS BIGINT)"


def phone10(key: str) -> str:
    return f"'9' || lpad(CAST(({key} * 7919 + 13) % 1000000000 AS STRING), 9, '0')"


def state_of(key: str) -> str:
    return f"CASE WHEN {key} % 2 = 0 THEN 'KA' ELSE 'UP' END"


def day_before(days: str) -> str:
    return f"CAST(DATE '{AS_OF}' - CAST({days} AS INT) AS STRING)"


# one JSON value per kind the flattening has to tell apart
JSON_VALUES = [
    '"  Text é "', "0", "12500", "1.5", '""', '"0"', "true", "false", "null", "[]",
    '["a"," b ",null,""]', "{}", '{"code":"c","name":"Town "}', '"+91 98765-43210"', '"yes"',
    '[{"x":1},"y"]', '"Summer Internship"', '"daily wage gig"', "9876543210",
]


def _json_value(key: str, index: int) -> str:
    values = ";".join(JSON_VALUES)
    n = len(JSON_VALUES)
    return f"split_part('{values}', ';', CAST(({key} * 7 + {key} % 11 + {index * 5}) % {n} AS INT) + 1)"


def _escaped(text: str) -> str:
    """A JSON text as a JSON string literal."""
    slash = f"replace({text}, chr(92), chr(92) || chr(92))"
    return f"""'"' || replace({slash}, '"', chr(92) || '"') || '"'"""


def json_documents(source: str, table: str, key: str, roots: list[str]) -> str:
    """FROM clause that adds one document column per root to `source`.

    A document holds every path the field map reads. Nested objects are spelled
    as JSON strings in every seventh row, and some documents are missing, empty,
    malformed or no object at all. Objects are built from the inside out, each
    level in a subquery of its own.
    """
    # a comment to DuckDB; to Spark a hint, because documents are heavy next to the rows their
    # keys come from: a task for every so many rows, see `bind`
    source = f"(SELECT /*+ REPARTITION(spread_{source.removeprefix('@')}, {key}) */ * FROM {source}) AS spread"
    levels: dict[int, dict[str, str]] = {}
    counter = iter(range(10_000))

    def build(node: dict, name: str, depth: int) -> None:
        parts = []
        for k, child in node.items():
            i = next(counter)
            if isinstance(child, dict):
                inner = f"{name}_{k}"
                build(child, inner, depth + 1)
                value = (
                    f"CASE WHEN ({key} + {i}) % 7 = 3 THEN {_escaped(inner)} "
                    f"WHEN ({key} + {i}) % 29 = 5 THEN 'null' ELSE {inner} END"
                )
            else:
                value = _json_value(key, i)
            parts.append(f"""'"{k}":' || {value}""")
        levels.setdefault(depth, {})[name] = "'{' || " + " || ',' || ".join(parts) + " || '}'"

    for root in roots:
        tree: dict = {}
        for field in FIELD_MAPS[table]:
            for path in field.paths:
                if path.root == root and path.keys:
                    node = tree
                    for k in path.keys[:-1]:
                        node = node.setdefault(k, {})
                    node.setdefault(path.keys[-1], None)
        build(tree, f"j_{root}", 0)
    for depth in sorted(levels, reverse=True):
        cols = ", ".join(f"{e} AS {n}" for n, e in levels[depth].items())
        source = f"(SELECT *, {cols} FROM {source}) AS level{depth}"
    return source


def json_document(root: str, key: str) -> str:
    return (
        f"CASE WHEN {key} % 37 = 4 THEN '[]' WHEN {key} % 37 = 5 THEN '' "
        f"WHEN {key} % 37 = 6 THEN NULL WHEN {key} % 37 = 7 THEN 'not json' "
        f"WHEN {key} % 37 = 8 THEN '[1,2]' WHEN {key} % 37 = 9 THEN j_{root} || '{{\"b\":2}}' ELSE j_{root} END AS {root}"
    )


SEEKER = "c_custkey"
CUSTOMERS = """@customer JOIN @nation ON c_nationkey = n_nationkey
    JOIN @region ON n_regionkey = r_regionkey"""

ADJ, NOUN = cycle(ADJECTIVES, step(SEEKER, 8)), cycle(NOUNS, step(SEEKER, 64))
ADJ2, NOUN2 = cycle(ADJECTIVES, step(SEEKER, 24)), cycle(NOUNS, step(SEEKER, 40))

BINDINGS = {
    "phones": f"""
SELECT c_custkey, {state_of(SEEKER)} AS state,
  CASE c_custkey % 9
    WHEN 0 THEN {phone10(SEEKER)}
    WHEN 1 THEN '+91 ' || substr({phone10(SEEKER)}, 1, 5) || '-' || substr({phone10(SEEKER)}, 6, 5)
    WHEN 2 THEN '091' || {phone10(SEEKER)}
    WHEN 3 THEN '91' || {phone10(SEEKER)}
    WHEN 4 THEN '9999999999'
    WHEN 5 THEN '12345'
    WHEN 6 THEN '  '
    WHEN 7 THEN NULL
    ELSE '(0)' || {phone10(SEEKER)} || '.0' END AS phone_raw,
  '+91' || {phone10(SEEKER)} AS phone
FROM @customer""",

    "profile": f"""
SELECT {state_of(SEEKER)} AS state, CAST(c_custkey AS STRING) AS id,
  'U' || CAST(c_custkey AS STRING) AS user_id,
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_name END AS name,
  CASE WHEN c_custkey % 21 = 0 THEN NULL WHEN c_custkey % 22 = 0 THEN '+12345'
       ELSE '+91' || {phone10(SEEKER)} END AS phone,
  CASE c_custkey % 8
    WHEN 2 THEN {ADJ} || ' ' || {NOUN} || ' | ' || {ADJ2} || ' ' || {NOUN2}
    WHEN 3 THEN '  '
    WHEN 4 THEN upper({ADJ} || ' ' || {NOUN})
    WHEN 5 THEN {NOUN}
    WHEN 6 THEN {ADJ} || ' ' || {ADJ2} || ' ' || {NOUN}
    WHEN 7 THEN {NOUN} || ' ' || {ADJ}
    ELSE {ADJ} || ' ' || {NOUN} END AS iti_specialization,
  CASE WHEN c_custkey % 16 = 3 THEN NULL ELSE {ADJ2} || ' ' || {NOUN2} END AS role,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'Institute ' || CAST(c_nationkey AS STRING) END AS iti_institute,
  CASE WHEN c_custkey % 10 = 0 THEN '' WHEN c_custkey % 10 = 1 THEN 'abc'
       ELSE CAST(18 + c_custkey % 40 AS STRING) END AS age,
  CASE WHEN c_custkey % 11 = 0 THEN '' ELSE r_name END AS llm_location_state,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE ' ' || n_name END AS llm_location_district,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE n_name || ', ' || r_name END AS current_location,
  n_name AS location_city, CASE WHEN c_custkey % 12 = 0 THEN ' ' ELSE r_name END AS location_state,
  CASE WHEN c_custkey % 13 = 0 THEN NULL
       ELSE CAST(10000 + (c_custkey % 30) * 1000 AS STRING) || CASE WHEN c_custkey % 2 = 0 THEN '.0' ELSE '' END
       END AS monthly_in_hand_preferred,
  nullif({cycle(QUALIFICATIONS, SEEKER)}, '') AS highest_qualification,
  CASE WHEN c_custkey % 25 = 0 THEN NULL
       ELSE {day_before(f'{SEEKER} % 120')} || CASE c_custkey % 3 WHEN 0 THEN ' 10:20:30.123456' WHEN 1 THEN ' 01:02:03' ELSE '' END
       END AS created_at,
  CASE WHEN c_custkey % 23 = 0 THEN '1' WHEN c_custkey % 23 = 1 THEN NULL WHEN c_custkey % 23 = 2 THEN '0.0'
       WHEN c_custkey % 23 = 3 THEN 'yes' WHEN c_custkey % 23 = 4 THEN ' ' ELSE '0' END AS test_flag,
  upper({ADJ2}) || ' ' || upper({NOUN2}) AS llm_role_normalized,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Manufacturing' END AS llm_role_sector,
  CASE WHEN c_custkey % 4 = 0 THEN '{{"whoIAm":{{"locationData":{{"gps":{{"lat":' || CAST(c_custkey % 90 AS STRING)
            || '.25,"lng":"' || CAST(c_custkey % 180 AS STRING) || '"}}}}}}}}'
       WHEN c_custkey % 4 = 1 THEN '{{"whoIAm":"none"}}' WHEN c_custkey % 4 = 2 THEN 'broken {{' END AS metadata
FROM {CUSTOMERS}""",

    "user_seeker": f"""
SELECT {state_of(SEEKER)} AS state, 'U' || CAST(c_custkey AS STRING) AS id, c_name AS name,
  'c' || CAST(c_custkey AS STRING) || CASE WHEN c_custkey % 14 = 0 THEN '+test1' ELSE '' END || '@example.org' AS email,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '+91' || {phone10(SEEKER)} END AS phone_number,
  {day_before(f'100 + {SEEKER} % 20')} AS created_at
FROM @customer
UNION ALL
SELECT {state_of(SEEKER)}, 'U' || CAST(c_custkey AS STRING), c_name,
  'a' || CAST(c_custkey AS STRING) || '@example.org', '+910000000000',
  CASE c_custkey % 15 WHEN 0 THEN NULL WHEN 5 THEN {day_before('10')} ELSE {day_before('200')} END
FROM @customer WHERE c_custkey % 5 = 0""",

    "raw_user": f"""
SELECT {state_of(SEEKER)} AS state, 'U' || CAST(c_custkey AS STRING) AS id,
  CASE WHEN c_custkey % 4 = 0 THEN '   ' ELSE '  ' || c_name || ' ' END AS name,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE ' c' || CAST(c_custkey AS STRING) || '@example.org' END AS email,
  {cycle(' admin,user ,,guest', SEEKER)} AS role,
  {cycle('t,f,TRUE, yes ,1,0,no,', SEEKER)} AS email_verified,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE {cycle('f,t,False,true', SEEKER)} END AS banned,
  CASE c_custkey % 5 WHEN 0 THEN {phone10(SEEKER)} WHEN 1 THEN '91 ' || {phone10(SEEKER)}
    WHEN 2 THEN NULL WHEN 3 THEN '-' ELSE '0-91-' || {phone10(SEEKER)} END AS phone_number
FROM @customer""",

    "member": f"""
SELECT {state_of(SEEKER)} AS state, 'seeker' AS side, 'U' || CAST(c_custkey AS STRING) AS user_id,
  CASE WHEN c_custkey % 17 = 0 THEN NULL
       ELSE CAST(c_custkey % (SELECT count(*) FROM @supplier) AS STRING) END AS organization_id,
  {cycle(' owner,member ,,  ', SEEKER)} AS role, {day_before('100')} AS created_at
FROM @customer
UNION ALL
SELECT {state_of(SEEKER)}, 'seeker', CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'U' || CAST(c_custkey AS STRING) END,
  CAST((c_custkey * 3) % (SELECT count(*) FROM @supplier) AS STRING), 'member',
  CASE c_custkey % 15 WHEN 0 THEN NULL WHEN 5 THEN {day_before('10')} ELSE {day_before('200')} END
FROM @customer WHERE c_custkey % 5 = 0""",

    "organization": """
SELECT s AS state, side, CAST(s_suppkey AS STRING) AS id,
  CASE WHEN s_suppkey % 9 = 0 THEN 'Test Org' WHEN s_suppkey % 10 = 0 THEN 'Demo-Works'
       WHEN s_suppkey % 11 = 0 THEN 'Testing Hall' ELSE s_name END AS name,
  'Contact ' || CAST(s_suppkey AS STRING) AS contact_person,
  CASE WHEN s_suppkey % 12 = 0 THEN '+1111111111' WHEN s_suppkey % 15 = 0 THEN NULL
       ELSE '+91' || """ + phone10("s_suppkey") + """ END AS contact_phone,
  CASE WHEN s_suppkey % 8 = 0 THEN 's' || CAST(s_suppkey AS STRING) || '@internal.example'
       WHEN s_suppkey % 14 = 0 THEN 'x+test1@example.org'
       ELSE 'S' || CAST(s_suppkey AS STRING) || '@example.org' END AS contact_email
FROM (SELECT *, 'KA' AS s, 'seeker' AS side FROM @supplier UNION ALL SELECT *, 'KA', 'provider' FROM @supplier
  UNION ALL SELECT *, 'UP', 'seeker' FROM @supplier UNION ALL SELECT *, 'UP', 'provider' FROM @supplier) AS sides""",

    "org_seeker": "SELECT * FROM #organization WHERE side = 'seeker'",
    "org_provider": "SELECT * FROM #organization WHERE side = 'provider'",

    "user_provider": """
SELECT s AS state, 'P' || CAST(s_suppkey AS STRING) AS id,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'Manager ' || s_name END AS name,
  CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE 'p' || CAST(s_suppkey AS STRING) || '@example.org' END AS email,
  CASE WHEN s_suppkey % 5 = 0 THEN '0' || """ + phone10("s_suppkey") + " ELSE " + phone10("s_suppkey") + """ END AS phone_number
FROM (SELECT *, 'KA' AS s FROM @supplier UNION ALL SELECT *, 'UP' FROM @supplier) AS states""",

    "posting_base": """
SELECT p.*, p_partkey % (SELECT count(*) FROM @supplier) AS supp FROM @part AS p""",

    "job_posting": f"""
SELECT {state_of('p_partkey')} AS state, CAST(p_partkey AS STRING) AS id, p_name AS title,
  CASE WHEN p_partkey % 50 = 1 THEN 'Repeated Role' WHEN p_partkey % 33 = 0 THEN NULL ELSE p_name END AS role,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE lower(p_type) || ' ' || p_name END AS job_title,
  CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ' ' || upper(p_name) WHEN 2 THEN '' ELSE p_name END AS llm_title_normalized,
  CASE WHEN p_partkey % 5 = 1 THEN 'Manufacturing' END AS llm_title_sector,
  p_name AS llm_role_normalized, lower(p_type) AS llm_role_sector,
  {cycle('open,Open, open ,closed', 'p_partkey')} AS status,
  CASE WHEN p_partkey % 50 = 1 THEN 'Repeat Works' WHEN p_partkey % 31 = 0 THEN NULL
       WHEN p_partkey % 29 = 0 THEN 'Sample Works' ELSE s_name END AS organization_name,
  CASE WHEN p_partkey % 26 = 0 THEN NULL ELSE CAST(supp AS STRING) END AS organization_id,
  CASE WHEN p_partkey % 50 = 1 THEN 'P1' WHEN p_partkey % 27 = 0 THEN NULL ELSE 'P' || CAST(supp AS STRING) END AS created_by,
  CASE WHEN p_partkey % 41 = 0 THEN 'not a date'
       ELSE {day_before('p_partkey % 120')} || CASE p_partkey % 3 WHEN 0 THEN ' 23:59:59.5' WHEN 1 THEN ' 00:00:00' ELSE '' END END AS created_at,
  '{{"city":"' || n_name || '"}}' AS location,
  CASE WHEN p_partkey % 50 = 1 THEN 'Same text' WHEN p_partkey % 19 = 0 THEN '' ELSE p_type || ' work with ' || p_name END AS job_description,
  CASE WHEN p_partkey % 50 = 1 THEN '3' WHEN p_partkey % 28 = 0 THEN 'many' WHEN p_partkey % 9 = 0 THEN ''
       WHEN p_partkey % 9 = 1 THEN '2.5' ELSE CAST(p_size % 5 AS STRING) END AS positions,
  CASE WHEN p_partkey % 50 = 1 THEN '9000' WHEN p_partkey % 7 = 0 THEN NULL
       WHEN p_partkey % 6 = 0 THEN CAST(12000 + p_size * 500 AS STRING) ELSE CAST(8000 + p_size * 500 AS STRING) END AS min_monthly_in_hand,
  CASE WHEN p_partkey % 50 = 1 THEN '12000' WHEN p_partkey % 8 = 0 THEN NULL WHEN p_partkey % 37 = 0 THEN 'negotiable'
       WHEN p_partkey % 6 = 0 THEN CAST(8000 + p_size * 500 AS STRING) || '.75' ELSE CAST(12000 + p_size * 500 AS STRING) END AS max_monthly_in_hand,
  {cycle(MIN_EDUCATION, 'p_partkey')} AS min_education_level,
  CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE lower(r_name) END AS llm_location_state,
  CASE WHEN p_partkey % 10 = 0 THEN '' ELSE lower(n_name) END AS llm_location_district,
  CASE WHEN p_partkey % 24 = 0 THEN '1' WHEN p_partkey % 24 = 1 THEN NULL ELSE '0' END AS test_flag
FROM #posting_base JOIN @supplier ON supp = s_suppkey
  JOIN @nation ON s_nationkey = n_nationkey JOIN @region ON n_regionkey = r_regionkey""",

    "job_application": f"""
SELECT {state_of('o_custkey')} AS state, CAST(o_orderkey AS STRING) AS id,
  CAST(pk - pk % 2 + o_custkey % 2 AS STRING) AS job_id, 'T' || CAST(o_orderkey AS STRING) AS transaction_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 'U' ELSE '' END || CAST(o_custkey AS STRING) AS user_id,
  'Customer ' || CAST(o_custkey AS STRING) AS user_name,
  CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'closed' ELSE 'archived' END AS status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Shortlisted' WHEN '5-LOW' THEN 'rejected' ELSE 'pending' END AS application_status,
  CASE WHEN o_orderkey % 4 = 0 THEN {day_before('o_orderkey % 110')} || ' 08:00:00'
       WHEN o_orderkey % 97 = 1 THEN '2001-08-01 10:00:00+00:00'
       ELSE CAST(o_orderdate AS STRING) END AS applied_at,
  CAST(o_orderdate AS STRING) AS updated_at,
  CASE WHEN o_orderkey % 45 = 0 THEN NULL
       ELSE '+91' || {phone10('o_custkey')} || CASE WHEN o_orderkey % 6 = 0 THEN '.0' ELSE '' END END AS seeker_phone,
  CASE WHEN o_orderkey % 35 = 0 THEN 'who+demo2@example.org' ELSE 'c' || CAST(o_custkey AS STRING) || '@example.org' END AS seeker_email,
  CAST(18 + o_custkey % 30 AS STRING) AS seeker_age, 'Fitter|Welder' AS seeker_iti_specialization,
  CAST(NULL AS STRING) AS seeker_highest_qualification,
  '{{"phone":"' || CAST(o_custkey AS STRING) || '"}}' AS contact, '{{"address":"street"}}' AS location,
  '{{"age":' || CAST(18 + o_custkey % 30 AS STRING) || '}}' AS metadata,
  o_orderpriority AS job_role, lower(o_orderpriority) AS job_title,
  upper(o_orderpriority) AS llm_job_title_normalized, CAST(NULL AS STRING) AS llm_job_title_sector,
  CASE WHEN o_orderkey % 40 = 0 THEN '1' ELSE '0' END AS test_flag
FROM @orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS pk FROM @lineitem GROUP BY l_orderkey) AS li
  ON o_orderkey = l_orderkey""",

    "denylist": f"""
SELECT '  ' || {phone10(SEEKER)} || ' ' AS value FROM @customer WHERE c_custkey % 40 = 0
UNION ALL SELECT '00' || {phone10('c_custkey + 1')} FROM @customer WHERE c_custkey % 80 = 0
UNION ALL SELECT 'C' || CAST(c_custkey AS STRING) || '@Example.org' FROM @customer WHERE c_custkey % 30 = 0
UNION ALL SELECT s_name || '@' FROM @supplier WHERE s_suppkey % 20 = 0
UNION ALL SELECT 'REPEAT works' UNION ALL SELECT '  ' UNION ALL SELECT 'Org 12'
UNION ALL SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'Testing Hall' ELSE ' ' END FROM @supplier""",

    "taxonomy": """
SELECT value, CASE WHEN value = 'old rod' THEN 'Any' WHEN value = 'hot ring' THEN NULL ELSE upper(value) END AS role,
  CASE WHEN value LIKE 'red%' THEN 'Automotive' WHEN value LIKE 'blue%' THEN 'Unheard Of' ELSE 'Manufacturing' END AS sector,
  CASE WHEN value LIKE '%widget' THEN 'Grey Collar' ELSE 'Blue Collar' END AS collar,
  value || ' hand' AS blue_collar_equivalent, value || ' technician' AS grey_collar_equivalent,
  value || ' engineer' AS white_collar_equivalent
FROM (SELECT DISTINCT p_name AS value FROM @part WHERE p_name NOT LIKE 'cold%') AS names""",

    "gazetteer": """
SELECT DISTINCT n_name || ', ' || r_name AS text, r_name AS state, n_name AS district
FROM @nation JOIN @region ON n_regionkey = r_regionkey WHERE n_nationkey % 5 <> 3""",

    "raw_profile": f"""
SELECT {state_of(SEEKER)} AS state, CAST(c_custkey AS STRING) AS id,
  {json_document('metadata', SEEKER)}
FROM {json_documents('@customer', 'profile', SEEKER, ['metadata'])}""",

    "raw_organization": f"""
SELECT CAST(s_suppkey AS STRING) AS id, s_name AS name,
  {json_document('metadata', 's_suppkey')}
FROM {json_documents('@supplier', 'organization', 's_suppkey', ['metadata'])}""",

    "raw_posting": f"""
SELECT {state_of('p_partkey')} AS state, CAST(p_partkey AS STRING) AS id,
  CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE ' ' || p_name END AS title,
  CASE WHEN p_partkey % 8 = 0 THEN '' ELSE p_type END AS description,
  {json_document('metadata', 'p_partkey')}
FROM {json_documents('@part', 'job_posting', 'p_partkey', ['metadata'])}""",

    "raw_application": f"""
SELECT CAST(o_orderkey AS STRING) AS id,
  CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN NULL ELSE 'Customer ' || CAST(o_custkey AS STRING) END AS user_name,
  {json_document('contact', 'o_orderkey')},
  {json_document('location', 'o_custkey')},
  {json_document('metadata', 'o_orderkey')}
FROM {json_documents('@orders', 'job_application', 'o_orderkey', ['contact', 'location', 'metadata'])}""",
}


def _needs(name: str) -> list[str]:
    """The binding and every binding below it, in order of definition."""
    found: list[str] = []
    for inner in re.findall(r"#(\w+)", BINDINGS[name]):
        found += [n for n in _needs(inner) if n not in found]
    return [*found, name]


def _resolved(name: str, table: str) -> str:
    text = re.sub(r"#(\w+)", r"b_\1", BINDINGS[name])
    return re.sub(r"@(customer|orders|lineitem|part|supplier|nation|region)\b", table, text)


def with_clause(*names: str) -> str:
    """WITH clause that defines bindings as b_<name> (for DuckDB)."""
    needed = list(dict.fromkeys(n for name in names for n in _needs(name)))
    parts = [f"b_{n} AS ({_resolved(n, r'\1')})" for n in needed]
    return "WITH " + ",\n".join(parts)


DOCUMENT_ROWS = 5_000  # rows whose documents one task builds


@cache
def _spark_sql(name: str, sf_dir: str) -> str:
    files = rf"parquet.`{sf_dir}/\1.parquet`"
    parts = [f"b_{n} AS ({_resolved(n, files)})" for n in _needs(name)]
    return "WITH " + ",\n".join(parts) + f"\nSELECT * FROM b_{name}"


def bind(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A logical table as a lazy DataFrame; documents are spread by the number of their rows."""
    def tasks(found: re.Match) -> str:
        rows = spark.read.parquet(f"{sf_dir}/{found[1]}.parquet").count()
        return str(max(1, -(-rows // DOCUMENT_ROWS)))

    return spark.sql(re.sub(r"\bspread_(\w+)", tasks, _spark_sql(name, sf_dir)))
