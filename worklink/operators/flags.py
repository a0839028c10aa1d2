"""Test and spam flags against a denylist and patterns (RUL-02..RUL-11, JN-22, JN-23, AGG-08)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklink.constants import (
    COUNTRY_PREFIXES,
    PHONE_LENGTHS,
    TEST_ORG_WORDS,
    TEST_PLUS_ADDRESS,
)
from worklink.functions.text import digits, email_domain, strip, trimmed
from worklink.operators.keyed import skew_join
from worklink.operators.keyfilter import KeyFilter
from worklink.session import size_setting

FLAG = "test_flag"


def parse_denylist(lines: DataFrame) -> DataFrame:
    """SRC-08: (kind, value) of a line-oriented denylist in column `value`.

    A line with '@' is an e-mail, one with a digit a phone, any other an organisation.
    """
    text = strip(F.col("value"))
    is_email, is_phone = text.contains("@"), text.rlike(r"(?U)\d")
    kind = F.when(is_email, "email").when(is_phone, "phone").otherwise("org")
    value = F.when(is_email, F.lower(text)).when(is_phone, digits(text)).otherwise(text)
    return (
        lines.filter(text != "").select(kind.alias("kind"), value.alias("value")).distinct()
    )


def phone_forms(d: Column) -> list[Column]:
    """Digit strings a phone is looked up under: itself and without a country prefix; null where a form does not differ."""
    forms = [d]
    for prefix in COUNTRY_PREFIXES:
        rest = F.when(d.startswith(prefix) & (F.length(d) > len(prefix)), F.regexp_replace(d, f"^{prefix}", ""))
        forms += [rest, F.when(rest.startswith("0"), F.ltrim(rest, F.lit("0")))]
    return forms


def bad_phone_shape(d: Column) -> Column:
    """All digits the same, or a length no phone has."""
    shortest, longest = PHONE_LENGTHS
    one_digit = F.replace(d, F.substring(d, 1, 1)) == ""
    return (d != "") & (one_digit | ~F.length(d).between(shortest, longest))


def bad_email_pattern(e: Column, domains: Sequence[str] = ()) -> Column:
    """Domain of an own organisation, or plus-addressing for tests."""
    return e.contains("@") & (email_domain(e).isin(*domains) | e.rlike(TEST_PLUS_ADDRESS))


def bad_org_pattern(n: Column, words: Sequence[str] = TEST_ORG_WORDS) -> Column:
    return n.rlike(r"(?iU)\b(" + "|".join(words) + r")\b")


def _key(kind: str, c: Column) -> Column:
    """The form a value is compared in, null when there is nothing to compare."""
    if kind == "phone":
        return F.nullif(digits(c), F.lit(""))
    text = F.lower(strip(c))
    return F.when(text.contains("@"), text) if kind == "email" else F.nullif(text, F.lit(""))


def in_denylist(df: DataFrame, key: str, kind: str, deny: DataFrame, name: str) -> DataFrame:
    """JN-23: adds a boolean column telling whether the denylist holds a key column.

    One existence join per form a key is looked up under. The list is the small side and
    the planner knows its size, so the table is not shuffled; should the list outgrow a
    broadcast, the joins split a phone that fills a third of the table.
    """
    listed = deny.filter(F.col("kind") == kind).select(F.lower("value").alias("_form")).distinct()
    hits = []
    for i, form in enumerate(_forms(kind, key)):
        hits.append(f"_hit_{i}")
        found = listed.withColumn(hits[-1], F.lit(True))
        df = skew_join(df.withColumn("_form", form), found, ["_form"]).drop("_form")
    hit = reduce(lambda a, b: a | b, [F.col(h).isNotNull() for h in hits])
    return df.withColumn(name, hit).drop(*hits)


ENTRY_BYTES = 100  # of a list's row in memory, to tell whether the list fits a broadcast


def denylist_filters(deny: DataFrame, limit: int | None = None) -> dict[str, KeyFilter] | None:
    """JN-23: filters of a list's values per kind, for a list beyond `limit` bytes; None for a smaller one, which is broadcast.

    The limit is that of a broadcast unless given. Eager: counts the list.
    """
    limit = size_setting(deny.sparkSession, "spark.sql.autoBroadcastJoinThreshold") if limit is None else limit
    counts = {r.kind: r["count"] for r in deny.groupBy("kind").count().collect()}
    if sum(counts.values()) * ENTRY_BYTES <= limit:
        return None
    lowered = deny.select("kind", F.lower("value").alias("_form"))
    return {k: KeyFilter.of(lowered.filter(F.col("kind") == k), ["_form"], counts.get(k, 0)) for k in ("phone", "email", "org")}


def _forms(kind: str, key: str) -> list[Column]:
    return phone_forms(F.col(key)) if kind == "phone" else [F.col(key)]


def _split_by_filters(df: DataFrame, checks: list[tuple[str, str]], filters: dict[str, KeyFilter]) -> tuple[DataFrame, DataFrame]:
    """Rows that may meet the list, and rows that meet nothing of it; tested where the rows are, nothing is shuffled."""
    may = []
    for kind, c in checks:
        for form in _forms(kind, f"_key_{c}"):
            may.append(f"_may_{len(may)}")
            df = filters[kind].mark(df, [form], may[-1])
    hit = reduce(lambda a, b: a | b, [F.col(m) for m in may])
    return df.filter(hit).drop(*may), df.filter(~hit).drop(*may)


def _column(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _flag(df: DataFrame, deny: DataFrame, phones: Sequence[str], emails: Sequence[str],
          orgs: Sequence[str], domains: Sequence[str], words: Sequence[str],
          filters: dict[str, KeyFilter] | None = None) -> DataFrame:
    """Sets the flag when any of the columns looks like a test value.

    With the `filters` of a large list only rows that may meet it are joined with it; the others stay where they are.
    """
    checks = [(k, c) for k, cs in (("phone", phones), ("email", emails), ("org", orgs)) for c in cs]
    out = df.drop(FLAG).withColumns({f"_key_{c}": _key(k, _column(df, c)) for k, c in checks})
    parts = [out] if filters is None else _split_by_filters(out, checks, filters)
    may = parts[0]
    for kind, c in checks:
        may = in_denylist(may, f"_key_{c}", kind, deny, f"_denied_{c}")
    clear = [p.withColumns({f"_denied_{c}": F.lit(False) for _, c in checks}) for p in parts[1:]]
    out = reduce(DataFrame.unionByName, [may, *clear])
    rules = []
    for kind, c in checks:
        text = trimmed(_column(df, c))
        rules.append(F.col(f"_denied_{c}"))
        if kind == "phone":
            rules.append(bad_phone_shape(digits(_column(df, c))))
        elif kind == "email":
            rules.append(bad_email_pattern(F.lower(text), domains))
        else:
            rules.append(bad_org_pattern(text, words))
    hit = reduce(lambda a, b: a | b, rules)
    helpers = [f"{p}_{c}" for _, c in checks for p in ("_key", "_denied")]
    return out.withColumn(FLAG, hit.cast("int")).drop(*helpers)


def flag_user(df, deny, domains=(), words=TEST_ORG_WORDS, filters=None):
    """RUL-05."""
    return _flag(df, deny, ["phone_number"], ["email"], [], domains, words, filters)


def flag_profile(df, deny, domains=(), words=TEST_ORG_WORDS, filters=None):
    """RUL-06."""
    return _flag(df, deny, ["phone"], [], [], domains, words, filters)


def flag_organization(df, deny, domains=(), words=TEST_ORG_WORDS, filters=None):
    """RUL-07."""
    return _flag(df, deny, ["contact_phone"], ["contact_email"], ["name"], domains, words, filters)


def flag_application(df, deny, domains=(), words=TEST_ORG_WORDS, filters=None):
    """RUL-09."""
    return _flag(df, deny, ["seeker_phone"], ["seeker_email"], [], domains, words, filters)


def flag_posting(df, deny, domains=(), words=TEST_ORG_WORDS, filters=None):
    """RUL-10: by the organisation's name as the posting spells it."""
    return _flag(df, deny, [], [], ["organization_name"], domains, words, filters)


def flagged(df: DataFrame) -> DataFrame:
    """FLT-13."""
    return df.filter(F.col(FLAG) == 1)


def flag_member(members: DataFrame, organizations: DataFrame) -> DataFrame:
    """RUL-08, JN-22: members of a flagged organisation of the same state and side."""
    scope = [c for c in ("state", "side") if c in members.columns and c in organizations.columns]
    hit = (
        flagged(organizations)
        .select(*scope, F.col("id").alias("organization_id"))
        .dropna()
        .distinct()
        .withColumn("_hit", F.lit(1))
    )
    joined = skew_join(members.drop(FLAG), hit, [*scope, "organization_id"])
    return joined.withColumn(FLAG, F.coalesce("_hit", F.lit(0))).drop("_hit")


FLAG_RULES = {
    "user": flag_user,
    "profile": flag_profile,
    "organization": flag_organization,
    "job_application": flag_application,
    "job_posting": flag_posting,
}


def flag_table(df: DataFrame, table: str, deny: DataFrame, domains: Sequence[str] = (),
               words: Sequence[str] = TEST_ORG_WORDS,
               organizations: DataFrame | None = None, filters: dict[str, KeyFilter] | None = None) -> DataFrame:
    """RUL-11: the rule of a table; members need their flagged organisations. `filters` are those of a large list."""
    if table == "member":
        if organizations is None:
            raise ValueError("members are flagged by their organisations")
        return flag_member(df, organizations)
    if table not in FLAG_RULES:
        raise ValueError(f"unknown table {table!r}")
    return FLAG_RULES[table](df, deny, domains, words, filters)


def flag_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """AGG-08: rows and flagged rows per table and over all ('total')."""
    rows = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(t).alias("name"), F.col(FLAG).cast("long").alias("f"))
         for t, df in tables.items()],
    )
    return (
        rows.rollup("name")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("f"), F.lit(0)).alias("n_flagged"))
        .select(F.coalesce("name", F.lit("total")).alias("name"), "n_rows", "n_flagged")
    )
