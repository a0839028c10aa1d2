"""Periodic runs of words by maximal-pair enumeration.

A run is a stretch of words with smallest period q that is at least max(LEAST, TIMES * q) words long and that no
neighbouring word extends. Its first place s and s + q are a *maximal pair*: the words from both agree for
length - q places, differ behind them, and the words to their left differ. Conversely every maximal pair whose distance
d satisfies common >= max(LEAST - d, (TIMES - 1) * d) is the start and one period of a run, or a multiple of its
period; the least distance per stretch remains. Nothing needs to be extended.

Maximal pairs come from the LCP-interval tree, walked bottom-up: an interval holds the places of its suffixes in text
order, each with its left word as class, and when two children meet, pairs of different classes within reach are
reported. Places of an interval within reach of each other lie in one periodic stretch, so all but the
first of them have the same left word (the last word of the period). One look at the farthest place
within reach on the left, and one at the nearest on the right, therefore does the work of a list per class.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklink.llm.common import id_and_text

LEAST, TIMES = 6, 4  # a run has at least LEAST words and TIMES periods
SHALLOWEST = min(max(LEAST - q, (TIMES - 1) * q) for q in range(1, LEAST))  # least common part of a pair
GRAM = 4  # words of the first filter, at most SHALLOWEST
SLICE_WORDS = 500_000  # words that are sorted at once; a longer text is a slice of its own

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = pa.schema([("doc_id", pa.int64()), ("runs", RUNS), ("collapsed", pa.string())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, runs, collapsed) for every row: its runs (start, length, period) by start, then period, and its text without
    repeated periods.

    Words are separated by ASCII blanks and numbered from 0. `collapsed` joins by one space the words that no run contains
    behind its first period. Null, empty and blank texts have no words, no runs and ''. Texts are
    read whole, whatever their length: memory grows with the longest one. Repeated rows and null ids
    are rows like others; an empty table gives no rows; other columns are not read.
    """
    schema = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return id_and_text(docs, id_col, text_col).mapInArrow(_batches, schema)


def run_digests(found: DataFrame) -> DataFrame:
    """One row per document with the number of runs, the longest one (ties: smallest start, then period) and sha256 digests."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
        F.floor(F.expr("1000 * _best.length div -_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) where a tenth of the texts has a periodic end, by the crc32 of the id.

    With h = crc32(id as text), g = h div 10: where h % 10 = 0 and a text has n > 0 words, every word from a = g % n on
    is one of the first 1 + (n - a) div (3 + g % 8) words from there, in turn. Texts that are left alone stay as
    they are; a null id leaves its text alone.
    """
    h = F.crc32(F.col(id_col).cast("string"))
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), h.alias("_h"))
    split = F.filter(F.split(F.trim(F.col("text")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    words = F.when(F.col("_h") % 10 == 0, split)
    listed = chosen.withColumn("_words", words).withColumn("_n", F.size("_words"))
    return listed.withColumns({
        "_a": F.when(F.col("_n") > 0, F.expr("(_h div 10) % _n").cast("int")),
    }).withColumn("_p", F.expr("cast(1 + (_n - _a) div (3 + (_h div 10) % 8) as int)")).select(
        "doc_id", F.when(F.col("_n") > 0, _repeated(F.col("_words"))).otherwise(F.col("text")).alias("text"))


def _repeated(words: Column) -> Column:
    unit = F.slice(words, F.col("_a") + 1, F.col("_p"))
    rest = F.flatten(F.array_repeat(unit, F.expr("cast((_n - _a) div _p + 1 as int)")))
    return F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), F.col("_a")), rest), F.lit(1), F.col("_n")), " ")


# ------------------------------------------------------------------ batches of texts


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        first = 0
        for last in _slices(texts):
            yield _slice(ids.slice(first, last - first), texts.slice(first, last - first))
            first = last


def _slices(texts: pa.Array) -> Iterator[int]:
    """Ends of slices of about SLICE_WORDS words, guessed from the texts' bytes."""
    held = 0
    for i, size in enumerate(pc.binary_length(texts).to_numpy(zero_copy_only=False)):
        if held and held + size > SLICE_WORDS * 6:
            yield i
            held = 0
        held += size
    if len(texts):
        yield len(texts)


def _slice(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    lists = pc.ascii_split_whitespace(texts)
    words, doc = lists.flatten(), np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(lists)))
    solid = np.asarray(pc.not_equal(words, "").to_numpy(zero_copy_only=False), bool)
    words, doc = words.filter(pa.array(solid)), doc[solid]
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    starts = np.searchsorted(doc, np.arange(len(texts) + 1))
    first, length, period = find_runs(codes, starts)

    # a word goes if a run contains it behind the run's first period
    edges = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edges, first + period, 1)
    np.add.at(edges, first + length, -1)
    kept = np.cumsum(edges[:-1]) == 0
    ends = np.concatenate([[0], np.cumsum(kept)])[starts]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.filter(pa.array(kept))), " ")

    of = np.searchsorted(starts, first, side="right") - 1
    rows = pa.StructArray.from_arrays([pa.array(first - starts[of]), pa.array(length), pa.array(period)], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(texts) + 1)), pa.int32()), rows)
    return pa.RecordBatch.from_arrays([ids, runs.cast(RUNS), collapsed.cast(pa.string())], schema=SCHEMA)


# ------------------------------------------------------------------ runs


def find_runs(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, length, period) of all runs of several texts, by first place, then period.

    `codes` are the words of all texts one after the other, `starts` the first place of each text and the end.
    """
    none = np.zeros(0, np.int64)
    levels, kept = suffix_ranks(codes, starts)
    if not len(kept):
        return none, none, none
    doc_end = np.repeat(starts[1:], np.diff(starts))
    order = kept[np.argsort(levels[-1][1][kept])]
    pairs = maximal_pairs(order, common_prefixes(order, levels, doc_end), _left_words(codes, starts, order))
    if not len(pairs):
        return none, none, none
    first, second, common = pairs.T
    period, length = second - first, second - first + common
    # of the multiples of a period over one stretch the least stays
    by = np.lexsort((period, length, first))
    first, length, period = first[by], length[by], period[by]
    new = np.concatenate([[True], (first[1:] != first[:-1]) | (length[1:] != length[:-1])])
    first, length, period = first[new], length[new], period[new]
    by = np.lexsort((period, first))
    return first[by], length[by], period[by]


def _left_words(codes: np.ndarray, starts: np.ndarray, places: np.ndarray) -> dict[int, int]:
    """The word to the left of each place; the first place of a text has a class of its own."""
    left = np.where(np.isin(places, starts), -1, codes[places - 1])
    return dict(zip(places.tolist(), left.tolist()))


def suffix_ranks(codes: np.ndarray, starts: np.ndarray) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4... words, and the places that can belong to a maximal pair.

    Suffixes of different texts always differ. Only groups that still hold several suffixes are sorted again; texts without a
    place that can be the first or second of a pair are left out after GRAM words.
    """
    n = len(codes)
    if not n:
        return [], np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    end = starts[1:][doc]
    key = doc * (int(codes.max()) + 1) + codes
    rank, active = _refined(key, np.arange(n), None)
    levels, width, kept = [(1, rank)], 1, None
    while len(active):
        after = active + width
        inside = after < end[active]
        second = np.zeros(len(active), np.int64)
        second[inside] = rank[after[inside]] + 1
        rank, active = _refined(rank[active] * (n + 1) + second, active, rank)
        width *= 2
        levels.append((width, rank))
        if width == GRAM:
            kept = _promising(rank, active)
            hopeful = np.zeros(len(starts) - 1, bool)
            hopeful[doc[kept]] = True
            active = active[hopeful[doc[active]]]
    return levels, kept if kept is not None else np.zeros(0, np.int64)


def _refined(key: np.ndarray, places: np.ndarray, rank: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """New ranks after sorting `places` by `key`, and the places whose key another place shares."""
    order = np.argsort(key)
    key, places = key[order], places[order]
    n = len(key)
    new = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    out = np.empty(n, np.int64) if rank is None else rank.copy()
    if rank is None:
        out[places] = group
    else:
        old = rank[places]
        fresh = np.concatenate([[True], old[1:] != old[:-1]])
        out[places] = old + group - np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    alone = new & np.concatenate([new[1:], [True]])
    return out, places[~alone]


def _promising(rank: np.ndarray, active: np.ndarray) -> np.ndarray:
    """Places that can be the first or second of a maximal pair that is a run.

    In a run from s with period q every place up to GRAM words before the end less q has its words again at most q
    places later. So from s at least 3q - 3, and from s + q at least 2q - 3 places in a row
    have a next occurrence, and theirs is at most q places away.
    """
    n = len(rank)
    key = np.sort(rank[active] * n + active)
    place, group = key % n, key // n
    again = np.flatnonzero(group[1:] == group[:-1])
    gap = np.zeros(n, np.int64)
    gap[place[again]] = place[again + 1] - place[again]
    barren = np.concatenate([np.flatnonzero(gap == 0), [n]])
    here = np.flatnonzero(gap)
    row = barren[np.searchsorted(barren, here)] - here
    return here[row >= (TIMES - 2) * gap[here] - (GRAM - 1)]


def common_prefixes(order: np.ndarray, levels: list[tuple[int, np.ndarray]], doc_end: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix and the next one in order, from ranks by 1, 2, 4... words."""
    a, b = order[:-1].copy(), order[1:].copy()
    last = doc_end[order]
    common = np.zeros(len(a), np.int64)
    for width, rank in reversed(levels):
        inside = (a < last[:-1]) & (b < last[1:])
        same = np.zeros(len(a), bool)
        same[inside] = rank[a[inside]] == rank[b[inside]]
        common[same] += width
        a[same] += width
        b[same] += width
    return common


def maximal_pairs(order: np.ndarray, common: np.ndarray, left: dict[int, int]) -> np.ndarray:
    """(first, second, common part) of the maximal pairs with common >= (TIMES - 1) * distance and >= SHALLOWEST."""
    found: list[tuple[int, int, int]] = []

    def joined(a: list[int], b: list[int], depth: int) -> list[int]:
        """The places of two children of an interval, after reporting the pairs between them."""
        small, big = (a, b) if len(a) <= len(b) else (b, a)
        reach = depth // (TIMES - 1)
        for place in small:
            own = left[place]
            at = bisect_left(big, place - reach)
            if at < len(big) and big[at] < place and left[big[at]] != own:
                found.append((big[at], place, depth))
            at = bisect_right(big, place)
            while at < len(big) and big[at] <= place + reach and left[big[at]] != own:
                found.append((place, big[at], depth))
                at += 1
        if len(small) == 1:
            insort(big, small[0])
        else:
            big.extend(small)
            big.sort()
        return big

    intervals: list[list] = []  # open ones: depth and places, deeper towards the end
    places = order.tolist()
    for place, depth in zip(places, common.tolist() + [0]):
        node = [place]
        while intervals and intervals[-1][0] > depth:
            deep, others = intervals.pop()
            node = joined(others, node, deep)
        if depth < SHALLOWEST:
            continue
        if intervals and intervals[-1][0] == depth:
            intervals[-1][1] = joined(intervals[-1][1], node, depth)
        else:
            intervals.append([depth, node])
    return np.array(found, np.int64).reshape(-1, 3)
