"""Labels for free text: places and roles (LBL-01..LBL-05, PRJ-11, PRJ-18, PRJ-19, FN-34).

Texts are de-duplicated, labelled, and joined back. What labels them is
pluggable: a function from a list of texts to a list of dicts (an external
predictor, say) that runs batch by batch inside tasks, or a lookup table of
known texts with an optional similarity match.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklink.constants import (
    COLLARS,
    LABEL_BATCH,
    LOCATION_COLUMNS,
    ROLE_COLUMNS,
    ROLE_FIELDS,
    SECTORS,
)
from worklink.functions import variant as V
from worklink.functions.text import clean_str, is_empty_value, trimmed
from worklink.operators.keyed import skew_join
from worklink.operators.similarity import scored_pairs
from worklink.operators.stats import distinct_values
from worklink.session import read_or_empty, stage

Labeller = Callable[[list[str]], list[dict | None]]

class LabellerDown(RuntimeError):
    """The labeller gave no answer for the first batch."""


PLACE_FIELDS = ("state", "district")
# output suffix of each role label
ROLE_SUFFIXES = {"role": "normalized"} | {f: f for f in ROLE_FIELDS[1:]}


def location_text(df: DataFrame, cols: Sequence[str]) -> Column:
    """PRJ-11: non-blank location columns in order, joined by ', '; '' when all are blank."""
    return F.concat_ws(", ", *[clean_str(F.col(c)) for c in cols if c in df.columns])


def label_distinct(values: DataFrame, labeller: Labeller, fields: Sequence[str],
                   batch: int = LABEL_BATCH, concurrency: int | None = None,
                   check_first: bool = False) -> DataFrame:
    """LBL-01, LBL-03, UDF-02: labels the distinct texts in column `value`.

    Returns (value, answered, *fields). A batch whose call fails has `answered`
    false and null labels; a short reply is padded with nulls, a long one cut;
    an answer that is no dict, and a field that is no text, is null.
    `concurrency` limits how many batches are in flight, as an external
    predictor may demand. `check_first` labels one batch up front and stops when
    nothing comes back.
    """
    fields = list(fields)

    def answers(texts: list[str]) -> tuple[bool, list]:
        try:
            reply = list(labeller(texts))
        except Exception:  # a failed batch leaves its texts unlabelled
            return False, [None] * len(texts)
        return True, (reply + [None] * len(texts))[: len(texts)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                texts = frame["value"].iloc[start : start + batch].tolist()
                answered, reply = answers(texts)
                rows = [r if isinstance(r, dict) else {} for r in reply]
                out = {"value": texts, "answered": [answered] * len(texts)}
                for f in fields:
                    out[f] = [r[f] if isinstance(r.get(f), str) else None for r in rows]
                yield pd.DataFrame(out)

    schema = "value string, answered boolean, " + ", ".join(f"{f} string" for f in fields)
    first = None
    if check_first:
        # the first batch is asked once, and its answers are kept
        first = stage(stage(values.limit(batch)).mapInPandas(run, schema))
        if not first.isEmpty() and first.filter("answered").isEmpty():
            raise LabellerDown("the labeller gave no answer for the first batch")
        values = values.join(first.select("value"), "value", "left_anti")
    spread = values.repartition(concurrency, "value") if concurrency else values.repartition("value")
    rest = spread.mapInPandas(run, schema)
    return rest if first is None else first.unionByName(rest)


def _labelled(values: DataFrame, labeller: Labeller, fields: Sequence[str], store: str | None = None, **options) -> DataFrame:
    """Labels kept in the checkpoint folder: a predictor is asked once per text,
    however many columns and reports read the answer. With `store` it is asked once for all runs."""
    if store is not None:
        return stored_labels(values, labeller, fields, store, **options)
    return stage(label_distinct(values, labeller, fields, **options).drop("answered"))


def stored_labels(values: DataFrame, labeller: Labeller, fields: Sequence[str], store: str, **options) -> DataFrame:
    """LBL-01, LBL-03: labels of the distinct texts in column `value`, from a table that outlives the run.

    Only texts the table at the path `store` does not hold are sent; their answers are appended to it. Texts of a
    batch that got no answer have null labels and are not stored, so the next run sends them again. Should two runs store one
    text, the smaller answer counts. Eager.
    """
    spark = values.sparkSession
    schema = "value string, " + ", ".join(f"{f} string" for f in fields)

    def known() -> DataFrame:
        held = read_or_empty(spark, store, schema)
        return held.groupBy("value").agg(F.min(F.struct(*fields)).alias("_label"))

    unseen = stage(values.join(known(), "value", "left_anti"))
    if not unseen.isEmpty():
        answers = label_distinct(unseen, labeller, fields, **options)
        answers.filter("answered").drop("answered").write.mode("append").parquet(store)
    return stage(values.join(known(), "value", "left").select("value", *[F.col(f"_label.{f}").alias(f) for f in fields]))


def label_by_lookup(values: DataFrame, lookup: DataFrame, fields: Sequence[str],
                    floor: float | None = None) -> DataFrame:
    """Offline labels for the distinct texts in column `value` from known texts.

    `lookup` holds column `value` and the fields. A text equal to a known one up
    to case takes its labels; others take those of the most similar known text
    that reaches `floor`, the alphabetically first on ties.
    """
    known = lookup.select(
        F.lower(trimmed(F.col("value"))).alias("_key"), "value", *fields
    ).groupBy("_key").agg(F.min(F.struct("value", *fields)).alias("_label"))
    keyed = values.select("value", F.lower(trimmed(F.col("value"))).alias("_key"))
    out = skew_join(keyed, known, ["_key"])
    if floor is not None:
        rest = out.filter(F.col("_label").isNull()).select("value")
        names = known.select(F.col("_label.value").alias("value"))
        near = (
            scored_pairs(rest, names, floor)
            .groupBy(F.col("left_value").alias("value"))
            .agg(F.min(F.struct((-F.col("score")).alias("s"), "right_value")).alias("best"))
            .select("value", F.lower(trimmed(F.col("best.right_value"))).alias("_near"))
        )
        found = skew_join(near, known.withColumnsRenamed({"_key": "_near", "_label": "_other"}), ["_near"], "inner")
        out = out.join(found.select("value", "_other"), "value", "left").withColumn(
            "_label", F.coalesce("_label", "_other")
        )
    return out.select("value", *[F.col(f"_label.{f}").alias(f) for f in fields])


def conform_labels(labels: DataFrame) -> DataFrame:
    """LBL-05: 'Any' and missing roles carry over; unknown sectors and collars are null."""
    role = F.col("role")

    def conform(field: str) -> Column:
        value = F.col(field)
        if field == "sector":
            value = F.when(value.isin(*SECTORS), value)
        if field == "collar":
            value = F.when(value.isin(*COLLARS), value)
        return F.when(role == "Any", F.lit("Any")).when(role.isNotNull(), value)

    return labels.withColumns({f: conform(f) for f in ROLE_FIELDS if f != "role"})


def parse_reply(reply: Column, size: Column) -> Column:
    """FN-34: a text reply as exactly `size` answers: fence stripped, padded or cut.

    A reply that is no JSON array gives null, which callers treat as a failed batch.
    """
    text = trimmed(reply)
    bare = F.regexp_replace(F.regexp_replace(text, r"^```[^\n]*\n?", ""), r"\n?```$", "")
    items = F.try_variant_get(F.try_parse_json(bare), "$", "array<variant>")
    return F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.get(items, i))


def reply_answers(replies: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Replies (reply, size and any keys) as one row per position with its fields."""
    keys = [c for c in replies.columns if c not in ("reply", "size")]
    rows = replies.filter(F.col("size") > 0).select(
        *keys, F.posexplode(parse_reply(F.col("reply"), F.col("size"))).alias("pos", "answer")
    )
    return rows.select(
        *keys, "pos", *[V.text_field(V.get(F.col("answer"), f)).alias(f) for f in fields]
    )


def apply_taxonomy(df: DataFrame, cols: Sequence[str], lookup: DataFrame) -> DataFrame:
    """PRJ-18, JN-21: six label columns per source column, null without a match.

    The distinct combinations of the columns' texts are unpivoted, joined with the lookup once and pivoted back, so
    the table itself is joined once however many columns it has. Existing label columns are replaced, so a second
    run gives the same result.
    """
    outputs = {c: {f: f"llm_{c}_{s}" for f, s in ROLE_SUFFIXES.items()} for c in cols}
    df = df.drop(*[o for names in outputs.values() for o in names.values()])
    there = [c for c in cols if c in df.columns]
    labels = lookup.select(F.col("value").alias("_raw"), F.struct(*ROLE_FIELDS).alias("_label"))
    raws = {c: f"_raw_{i}" for i, c in enumerate(there)}
    df = df.withColumns({r: F.coalesce(clean_str(F.col(c)), F.lit("")) for c, r in raws.items()})
    if len(there) == 1:
        df = skew_join(df.withColumnRenamed("_raw_0", "_raw"), labels, ["_raw"]).withColumnRenamed("_label", "_label_0").drop("_raw")
    elif there:
        keys = list(raws.values())
        combined = df.select(*keys).distinct()
        texts = combined.select(*keys, F.posexplode(F.array(*keys)).alias("_at", "_raw")).filter("_raw <> ''")
        found = skew_join(texts, labels, ["_raw"], "inner").groupBy(*keys).agg(*[
            F.max(F.when(F.col("_at") == i, F.col("_label"))).alias(f"_label_{i}") for i in range(len(keys))])
        df = skew_join(df, found, keys).drop(*keys)
    null = F.lit(None).cast("string")
    return df.withColumns({
        o: F.col(f"_label_{there.index(c)}.{f}") if c in there else null for c, names in outputs.items() for f, o in names.items()
    }).drop(*[f"_label_{i}" for i in range(len(there))])


def role_lookup(tables: list[DataFrame], cols: Sequence[str],
                labeller: Labeller | DataFrame, floor: float | None = None, **options) -> DataFrame:
    """LBL-03, LBL-04: labels of the distinct values; empty values are not sent."""
    values = distinct_values(tables, list(cols)).filter(~is_empty_value(F.col("value")))
    if isinstance(labeller, DataFrame):
        return stage(label_by_lookup(values, labeller, ROLE_FIELDS, floor))
    return _labelled(values, labeller, ROLE_FIELDS, **options)


def label_roles(tables: dict[str, DataFrame], labeller: Labeller | DataFrame,
                floor: float | None = None, **options) -> dict[str, DataFrame]:
    """LBL-04, PRJ-19: role labels of every table that has role columns."""
    out = dict(tables)
    for table, cols in ROLE_COLUMNS.items():
        if table in out:
            lookup = role_lookup([out[table]], cols, labeller, floor, **options)
            out[table] = apply_taxonomy(out[table], cols, lookup)
    if "profile" in out:
        out["profile"] = out["profile"].withColumn("normalised_role", F.col("llm_role_normalized"))
    return out


def label_locations(df: DataFrame, cols: Sequence[str], labeller: Labeller | DataFrame,
                    floor: float | None = None, **options) -> DataFrame:
    """LBL-01, LBL-02, FLT-09: state and district of each row's location text.

    Rows without any location text are not sent. Equal texts are sent once.
    """
    df = df.drop("llm_location_state", "llm_location_district")
    if not any(c in df.columns for c in cols):
        return df.withColumns({
            f"llm_location_{f}": F.lit(None).cast("string") for f in PLACE_FIELDS
        })
    keyed = df.withColumn("_text", F.nullif(location_text(df, cols), F.lit("")))
    values = keyed.select(F.col("_text").alias("value")).filter("value IS NOT NULL").distinct()
    if isinstance(labeller, DataFrame):
        labels = label_by_lookup(values, labeller, PLACE_FIELDS, floor)
    else:
        labels = _labelled(values, labeller, PLACE_FIELDS, **options)
    renamed = labels.select(
        F.col("value").alias("_text"), *[F.col(f).alias(f"llm_location_{f}") for f in PLACE_FIELDS]
    )
    return skew_join(keyed, renamed, ["_text"]).drop("_text")


def label_all_locations(tables: dict[str, DataFrame], labeller: Labeller | DataFrame,
                        **options) -> dict[str, DataFrame]:
    """LBL-02: every table that has location columns."""
    return {
        t: label_locations(df, LOCATION_COLUMNS[t], labeller, **options)
        if t in LOCATION_COLUMNS else df
        for t, df in tables.items()
    }
