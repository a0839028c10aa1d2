"""Exact duplicates by progressive refinement: length, prefix hash, full hash, content.

Every step groups only what the one before left in groups of several rows. The text itself never moves for a
hash: the surviving keys reach the scan as a bitmap of bounded size (`KeyFilter`), and rows
that pass are hashed where they are read. Only texts of groups that survive the full hash are shuffled, combined
per task beforehand, and compared by content. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklink.llm.common import stored
from worklink.operators.keyfilter import KeyFilter

#: Runs of blanks that are not yet one space.
BLANKS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
PREFIX = 64  # characters that the prefix hash reads


def squeezed(text: Column) -> Column:
    """A text with every run of ASCII blanks as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False,
                     prefix_hash: Callable[[Column], Column] = F.xxhash64,
                     full_hash: Callable[[Column], Column] = sha256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) for every row: which rows hold equal texts, and which one stays.

    Texts are equal when they agree after `squeezed`; the content decides, whatever the hashes say.
    The smallest id of a group stays. `digest` is the full hash where it was taken; with `digests` it is taken for every row.

    Null and empty texts are one group. A null id never stays where the group has an id; rows
    with equal ids count as one (`kept` is true for all of them, also for rows without id in a group
    that has none). A text may be of any length. An empty table gives no rows. Other
    columns are not read. Eager: the keys that survive a step are stored tables.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), squeezed(F.col(text_col)).alias("text"))
    sized = texts.withColumn("length", F.octet_length("text"))
    early = stored(sized.select("length", prefix_hash(F.substring("text", 1, PREFIX)).alias("prefix")), "prefixes")
    lengths = stored(_shared(early, ["length"]), "lengths")
    prefixes = stored(_shared(early.join(lengths, "length", "left_semi"), ["length", "prefix"]), "prefix_groups")
    alike = KeyFilter.of(prefixes, ["length", "prefix"], prefixes.count())

    # rows that share length and prefix with another are hashed in full, in the scan
    marked = alike.mark(sized.withColumn("prefix", prefix_hash(F.substring("text", 1, PREFIX))),
                        [F.col("length"), F.col("prefix")], "alike")
    hashed = marked.withColumn("digest", F.when(F.col("alike") | F.lit(digests), full_hash(F.col("text"))))
    rows = stored(hashed.select("doc_id", "length", "digest", "alike"), "hashed")
    equal = stored(_shared(rows.filter("alike"), ["length", "digest"]), "hash_groups")

    # full content, only of rows whose full hash another row has
    same = KeyFilter.of(equal, ["length", "digest"], equal.count())
    survivors = same.mark(hashed.filter("alike"), [F.col("length"), F.col("digest")], "same").filter("same")
    contents = survivors.groupBy("length", "digest", "text").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = stored(contents.groupBy("length", "digest").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count(F.lit(1)).alias("n_texts")), "contents")

    clear = groups.filter("n_texts = 1 AND group_size > 1").drop("n_texts")
    clash = groups.filter("n_texts > 1").select("length", "digest")
    out = _result(rows.join(clash, ["length", "digest"], "left_anti").join(clear, ["length", "digest"], "left"))
    if clash.isEmpty():
        return out
    # different texts under one full hash: their rows are grouped by the text itself
    apart = survivors.join(clash, ["length", "digest"], "left_semi").select("doc_id", "length", "digest", "text")
    return out.unionByName(_result(apart.join(contents, ["length", "digest", "text"])))


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that several rows hold; counted per task before the shuffle."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")


def _result(rows: DataFrame) -> DataFrame:
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                       F.col("doc_id").eqNullSafe(keep).alias("kept"), "digest")
