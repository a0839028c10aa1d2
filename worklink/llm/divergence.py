"""How far the sources of a language diverge in their use of terms, by a frequent-pattern tree of term rows.

Every term of a language is a row of its counts per source. The smoothed frequencies of two sources are compared over
all terms, and most counts are zero. So with z the frequency of a count of zero, the sum over all terms of |p - q| is

    V * |zp - zq|  +  what single counts add  +  what terms that both have add beyond that,

each an exact integer. Single counts need the distinct counts of each source only. For the last part the
rows, ordered by source, form a frequent-pattern tree: rows with a common beginning share a path, and each
pair of a node and an ancestor is added once, with the number of rows below the node. The tree is never
held as a whole: rows sorted by path are its preorder, so a task goes through its range of the tree a batch of paths at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worklink.llm.common import short_batches, stored

SCALE, ADDED = 1_000_000_000, 5  # frequencies are 1 + floor(SCALE * (count + ADDED) / (N + ADDED * V))
CHUNK_BYTES = 16_000_000  # text that a task counts at once
HELD = 1_000_000  # pairs of sources that a task holds before it adds them up
#: ASCII characters other than letters separate terms; A-Z become small letters; every other byte stays.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))

COUNTS = "lang string, term string, docs long, counts array<struct<source:string,n:long>>"


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                      min_docs: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank) per group (lang, source).

    Part `pair` compares the group with each other source of its language (item): the summed difference of their smoothed
    frequencies of all kept terms. Part `term` lists the `top` terms that the group has and uses more often than
    its language, by the difference. Kept are terms in at least `min_docs` documents of the language.
    Ranks count from 1, value descending, item ascending by its UTF-8 bytes.

    Null texts, languages and sources are ''. A group without kept terms is compared like others; a language without kept
    terms gives pairs of value 0 and no terms; a single source gives no pairs. Every row counts, also repeated
    ones; texts of any length are read whole; an empty table gives no rows; other columns are not read.
    Eager: counts and term rows are stored tables.
    """
    parts = stored(_counted(docs, lang_col, source_col, text_col), "term_counts")
    seen = parts.filter("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("_docs"))
    kept = seen.filter(F.col("_docs") >= min_docs).drop("_docs")
    # only kept terms are told apart by source
    cells = parts.join(kept, ["lang", "term"]).select("lang", "term", F.inline("counts"))
    cells = cells.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    used = stored(cells.withColumn("in_lang", F.sum("n").over(Window.partitionBy("lang", "term"))), "used_terms")
    kept = used.groupBy("lang", "term").agg(F.max("in_lang").alias("in_lang"))
    every = parts.filter("term = ''").select("lang", F.inline("counts")).select("lang", "source").distinct()

    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("in_lang").alias("lang_total"))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_terms"))
    groups = every.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.fillna(0, ["total", "n_terms", "v", "lang_total"]).withColumn(
        "zero", F.when(F.col("v") > 0, frequency(F.lit(0), F.col("total"), F.col("v"))).otherwise(0))
    # sources in the order of their paths: those with many terms first
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n_terms"), "source"))
    groups = stored(groups.withColumn("place", order), "groups")

    facts = groups.select("lang", "source", "place", "total", "v", "lang_total", "zero")
    weighed = used.join(facts, ["lang", "source"]).withColumn("p", frequency(F.col("n"), F.col("total"), F.col("v")))
    pairs = _ranked(_pair_values(groups, weighed), None).withColumn("part", F.lit("pair"))
    above = weighed.withColumn("value", F.col("p") - frequency(F.col("in_lang"), F.col("lang_total"), F.col("v")))
    best = _ranked(above.filter("value > 0").withColumnRenamed("term", "item"), top).withColumn("part", F.lit("term"))
    out = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*out).unionByName(best.select(*out))


def frequency(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + ADDED) / (total + ADDED * terms)), exact; null without terms."""
    return F.call_function("div", (count.cast("long") + ADDED) * SCALE, total.cast("long") + terms * ADDED) + 1


def _ranked(rows: DataFrame, top: int | None) -> DataFrame:
    """Rank within a group; with `top` Spark keeps that many rows per task and group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    rows = rows.select("lang", "source", "item", "value").withColumn("rank", rank)
    return rows if top is None else rows.filter(F.col("rank") <= top)


# ------------------------------------------------------------------ counts


def _counted(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """Rows (lang, term, docs, counts) of parts of the table, with occurrences per source; the term '' lists all sources."""
    short_batches(docs.sparkSession)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
            for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    return docs.select(*text).mapInArrow(_term_batches, COUNTS)


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches are counted together until they hold CHUNK_BYTES of text."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(2).nbytes
        if size >= CHUNK_BYTES:
            yield _count(pa.Table.from_batches(held).combine_chunks())
            held, size = [], 0
    if held:
        yield _count(pa.Table.from_batches(held).combine_chunks())


def _folded(texts: pa.Array) -> pa.Array:
    """Texts with every separator as a blank and A-Z as small letters: byte for byte, so the offsets stay."""
    valid, offsets, data = texts.buffers()
    data = pa.py_buffer(data.to_pybytes().translate(FOLD)) if data is not None else None
    return pa.Array.from_buffers(texts.type, len(texts), [valid, offsets, data], offset=texts.offset)


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts the keys, the sorted keys without repeats, and where each begins in that order."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
    return order, keys[first], first


def _count(table: pa.Table) -> pa.RecordBatch:
    langs, sources = (table.column(i).combine_chunks().dictionary_encode() for i in (0, 1))
    lang, source = (x.indices.to_numpy().astype(np.int64) for x in (langs, sources))
    n_sources = len(sources.dictionary)
    lists = pc.ascii_split_whitespace(_folded(table.column(2).combine_chunks()))
    doc = np.repeat(np.arange(len(lang)), pc.list_value_length(lists).to_numpy())
    words = lists.flatten().dictionary_encode()
    n_words = len(words.dictionary)
    # occurrences of each word in each document
    found, n = np.unique(doc * n_words + words.indices.to_numpy(), return_counts=True)
    doc, word = found // max(n_words, 1), found % max(n_words, 1)
    blank = np.asarray(pc.equal(words.dictionary, "").to_numpy(zero_copy_only=False), bool)
    solid = ~blank[word]
    doc, word, n = doc[solid], word[solid] + 1, n[solid]
    # word 0 is the empty one: every group of the chunk
    doc, word, n, docs = (np.concatenate(x) for x in (
        (np.arange(len(lang)), doc), (np.zeros(len(lang), np.int64), word), (np.zeros(len(lang), np.int64), n),
        (np.zeros(len(lang), np.int64), np.ones(len(doc), np.int64))))
    order, cells, first = _grouped(((lang[doc] * (n_words + 1)) + word) * n_sources + source[doc])
    n, docs = (np.add.reduceat(x[order], first) if len(first) else x for x in (n, docs))
    rows, of = cells // n_sources, cells % n_sources
    start = np.flatnonzero(np.concatenate([np.ones(min(len(rows), 1), bool), rows[1:] != rows[:-1]]))
    docs = np.add.reduceat(docs, start) if len(start) else docs
    rows = rows[start]
    terms = pa.concat_arrays([pa.array([""], words.dictionary.type), words.dictionary])
    entries = pa.StructArray.from_arrays([sources.dictionary.take(pa.array(of)).cast(pa.string()), pa.array(n, pa.int64())], ["source", "n"])
    counts = pa.ListArray.from_arrays(pa.array(np.append(start, len(of)), pa.int32()), entries)
    return pa.RecordBatch.from_arrays(
        [langs.dictionary.take(pa.array(rows // (n_words + 1))).cast(pa.string()),
         terms.take(pa.array(rows % (n_words + 1))).cast(pa.string()), pa.array(docs, pa.int64()), counts], ["lang", "term", "docs", "counts"])


# ------------------------------------------------------------------ pairs


def _pair_values(groups: DataFrame, weighed: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language, both ways."""
    side = groups.select("lang", "source", "place", "zero", "v")
    other = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("other"), F.col("zero").alias("other_zero"))
    pairs = side.join(other, "lang").filter("place <> other")
    alone = single_counts(groups, weighed)
    tree = tree_sums(weighed)
    both_ways = tree.unionByName(tree.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    joined = (
        pairs.join(alone.select("lang", F.col("place"), F.col("other"), F.col("value").alias("_own")), ["lang", "place", "other"], "left")
        .join(alone.select("lang", F.col("other").alias("place"), F.col("place").alias("other"), F.col("value").alias("_its")),
              ["lang", "place", "other"], "left")
        .join(both_ways.select("lang", F.col("a").alias("place"), F.col("b").alias("other"), F.col("value").alias("_both")),
              ["lang", "place", "other"], "left"))
    value = F.col("v") * F.abs(F.col("zero") - F.col("other_zero"))
    for part in ("_own", "_its", "_both"):
        value += F.coalesce(F.col(part), F.lit(0))
    return joined.select("lang", "source", "item", value.alias("value"))


def single_counts(groups: DataFrame, weighed: DataFrame) -> DataFrame:
    """(lang, place, other, value): what a source's counts add against a source that has none of the terms.

    That is the sum over its terms of |p - z| - |its z - z|, with z the other's frequency of zero. The distinct
    frequencies of a source and the z of all others are put on one line; running sums from the left and totals give it.
    """
    bars = weighed.groupBy("lang", "place", "p").agg(F.count(F.lit(1)).alias("m")).select(
        "lang", "place", F.col("p").alias("at"), "m", (F.col("p") * F.col("m")).alias("pm"), F.lit(0).alias("other"),
        F.lit(0).cast("long").alias("own_zero"))
    zeros = groups.select("lang", F.col("place").alias("other"), F.col("zero").alias("at"))
    asked = groups.filter("n_terms > 0").select("lang", "place", F.col("zero").alias("own_zero")).join(zeros, "lang").filter(
        "place <> other").select("lang", "place", "at", F.lit(0).cast("long").alias("m"), F.lit(0).cast("long").alias("pm"), "other", "own_zero")
    line = bars.unionByName(asked)
    whole = Window.partitionBy("lang", "place")
    upto = whole.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = line.withColumns({"_m": F.sum("m").over(upto), "_pm": F.sum("pm").over(upto),
                             "_all": F.sum("m").over(whole), "_all_pm": F.sum("pm").over(whole)}).filter("other > 0")
    apart = F.col("at") * F.col("_m") - F.col("_pm") + (F.col("_all_pm") - F.col("_pm")) - F.col("at") * (F.col("_all") - F.col("_m"))
    return sums.select("lang", "place", "other", (apart - F.col("_all") * F.abs(F.col("own_zero") - F.col("at"))).alias("value"))


def tree_sums(weighed: DataFrame) -> DataFrame:
    """(lang, a, b, value) for a before b in path order: what terms that both sources have add beyond their single counts."""
    rows = weighed.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("place", "n", "p", "zero"))).alias("path"))
    paths = rows.filter(F.size("path") > 1).groupBy("lang", "path").agg(F.count(F.lit(1)).alias("m"))
    ordered = paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    flat = ordered.select("lang", *[F.col(f"path.{c}").alias(c) for c in ("place", "n", "p", "zero")], "m")
    parts = flat.mapInArrow(_walk, "lang string, a int, b int, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per pair of sources of the part of the tree that a batch of sorted paths spans."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        code = langs.indices.to_numpy()
        for c, lang in enumerate(langs.dictionary.to_pylist()):
            rows = np.flatnonzero(code == c)
            part = batch.slice(rows[0], rows[-1] + 1 - rows[0])
            depth = pc.list_value_length(part.column(1)).to_numpy()
            items = [part.column(i).flatten().to_numpy() for i in range(1, 5)]
            for a, b, value in pair_sums(depth, *items, part.column(5).to_numpy()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(value, pa.int64())],
                    ["lang", "a", "b", "value"])


def pair_sums(depth: np.ndarray, place: np.ndarray, n: np.ndarray, p: np.ndarray, zero: np.ndarray,
              m: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, sum) over the tree of sorted paths, given as depths and their items one after the other; path r stands for m[r] rows.

    A node is the first of the neighbouring paths that agree down to it, and stands for the rows of all of them. Level by
    level, all nodes are compared with their ancestors at once, each combination a single time.
    """
    widest = int(depth.max())
    row, level = np.repeat(np.arange(len(depth)), depth), np.arange(len(place)) - np.repeat(np.cumsum(depth) - depth, depth)
    grid = np.zeros((4, len(depth), widest), np.int64)
    grid[:, row, level] = place, n, p, zero
    place, n, p, zero = grid
    inside = np.arange(widest) < depth[:, None]
    same = np.zeros((len(depth), widest), bool)  # agrees with the path before down to this level
    same[1:] = inside[1:] & inside[:-1] & (place[1:] == place[:-1]) & (n[1:] == n[:-1])
    same = np.logical_and.accumulate(same, axis=1)
    before = np.concatenate([[0], np.cumsum(m)])
    held, size = [], 0
    for k in range(1, widest):
        ends = np.append(np.flatnonzero(~same[:, k]), len(depth))
        first = ends[:-1]
        rows = before[ends[1:]] - before[first]
        deep = inside[first, k]
        first, rows = first[deep], rows[deep]
        p_k, zero_k = p[first, k, None], zero[first, k, None]
        q, other = p[first, :k], zero[first, :k]
        add = np.abs(q - p_k) - np.abs(q - zero_k) - np.abs(other - p_k) + np.abs(other - zero_k)
        held.append(((place[first, :k] << 32 | place[first, k, None]).ravel(), (add * rows[:, None]).ravel()))
        size += add.size
        if size > HELD:
            yield _summed(held)
            held, size = [], 0
    if held:
        yield _summed(held)


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, values = (np.concatenate(x) for x in zip(*held))
    order, keys, first = _grouped(keys)
    sums = np.add.reduceat(values[order], first) if len(first) else values
    return keys >> 32, keys & 0xFFFFFFFF, sums
