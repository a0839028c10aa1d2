"""Token-set similarity of texts and an exact similarity join (UDF-01, RUL-12..14, JN-01).

The join finds every pair of distinct texts whose score reaches a floor. A pair
qualifies in one of two ways:

* it shares a token: found by an equi-join on tokens;
* it shares none: its score is 2 * LCS / (length sum), and an LCS is never longer
  than the common part of the two character multisets. Texts fall into classes by how many
  characters of a few groups they have; an interval join of the classes by length finds those whose bound on
  the common part allows it, so every pair is formed once at most.

Everything is a DataFrame expression; nothing but sizes of hot keys reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklink.operators.keyed import key_rows, product_join, result_sizes
from worklink.session import stage

# groups of characters whose numbers bound the common part of two texts; the last group is the rest
GROUPS = ["aeiouAEIOU", "nrstNRST", "lhdcmLHDCM", " "]
# a text's number in a group counts as the largest of the level it falls in; the last level is open
LEVELS = [0, 1, 2, 4, 6, 9, 13]
SLACK = 0.0001  # covers the rounding of scores to four decimals
WORD = 62  # bits of a word: an addition in one leaves its carry in the next bit
FULL = (1 << WORD) - 1
SPLIT = 16  # tasks of a band of class pairs
PAIR_ROWS = 10_000  # pairs that one task compares: about a second's work


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _shift(value: Column, by: Column) -> Column:
    return F.call_function("shiftleft", value, by)


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two texts, bit-parallel (Hyyro 2004).

    The shorter text's places are bits of 62-bit words; every character of the longer one
    updates them at once. Texts of any length; null where one is null.
    """
    def compared(t: Column) -> Column:
        size = F.length(t["short"])
        return F.when(size == 0, 0).when(size <= WORD, _one_word(t["long"], t["short"])).otherwise(_many_words(t["long"], t["short"]))

    swap = F.length(a) < F.length(b)
    both = F.struct(F.when(swap, b).otherwise(a).alias("long"), F.when(swap, a).otherwise(b).alias("short"))
    return _let(both, compared)


def _one_word(long_: Column, short: Column) -> Column:
    def places(chars: Column) -> Column:
        bits = F.transform(chars, lambda c, i: F.struct(c.alias("c"), _shift(_long(1), i).alias("bit")))
        return _let(F.struct(F.array_distinct(chars).alias("kinds"), bits.alias("bits"), (_shift(_long(1), F.size(chars)) - 1).alias("full")), masks)

    def masks(s: Column) -> Column:
        def mask(kind: Column) -> Column:
            return F.aggregate(s["bits"], _long(0), lambda sum_, b: F.when(b["c"] == kind, sum_ + b["bit"]).otherwise(sum_))

        return _let(F.struct(F.map_from_arrays(s["kinds"], F.transform(s["kinds"], mask)).alias("of"), s["full"].alias("full")), run)

    def run(s: Column) -> Column:
        def step(row: Column, mask: Column) -> Column:
            return (row + row.bitwiseAND(mask)).bitwiseOR(row.bitwiseAND(F.bitwise_not(mask))).bitwiseAND(_long(FULL))

        hits = F.transform(F.split(long_, ""), lambda c: F.coalesce(F.try_element_at(s["of"], c), _long(0)))
        row = F.aggregate(hits, s["full"], step)
        return F.bit_count(s["full"].bitwiseAND(F.bitwise_not(row)))

    return _let(F.split(short, ""), places)


def _many_words(long_: Column, short: Column) -> Column:
    def places(chars: Column) -> Column:
        spots = F.transform(chars, lambda c, i: F.struct(c.alias("c"), F.floor(i / WORD).cast("int").alias("word"),
                                                         _shift(_long(1), i % WORD).alias("bit")))
        words = F.sequence(F.lit(0), F.floor((F.size(chars) - 1) / WORD).cast("int"))
        return _let(F.struct(F.array_distinct(chars).alias("kinds"), spots.alias("spots"), words.alias("words"), F.size(chars).alias("n")), masks)

    def masks(s: Column) -> Column:
        def mask(kind: Column) -> Column:
            own = F.filter(s["spots"], lambda p: p["c"] == kind)
            return _let(own, lambda mine: F.transform(s["words"], lambda w: F.aggregate(
                mine, _long(0), lambda sum_, p: F.when(p["word"] == w, sum_ + p["bit"]).otherwise(sum_))))

        return _let(F.struct(F.map_from_arrays(s["kinds"], F.transform(s["kinds"], mask)).alias("of"),
                             s["words"].alias("words"), s["n"].alias("n")), run)

    def run(s: Column) -> Column:
        def step(row: Column, mask: Column) -> Column:
            """All words of a row, low to high, with the carry of the addition."""
            def word(acc: Column, w: Column) -> Column:
                v, m = F.get(row, w), F.get(mask, w)
                total = v + v.bitwiseAND(m) + acc["carry"]
                new = total.bitwiseAND(_long(FULL)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m)))
                return F.struct(F.array_append(acc["row"], new).alias("row"), F.shiftright(total, WORD).alias("carry"))

            start = F.struct(F.array().cast("array<bigint>").alias("row"), _long(0).alias("carry"))
            return F.when(mask.isNull(), row).otherwise(F.aggregate(s["words"], start, word)["row"])

        hits = F.transform(F.split(long_, ""), lambda c: F.try_element_at(s["of"], c))
        row = F.aggregate(hits, F.transform(s["words"], lambda _: _long(FULL)), step)
        zeros = F.transform(row, lambda v, w: F.bit_count(F.bitwise_not(v).bitwiseAND(
            _shift(_long(1), F.least(F.lit(WORD), s["n"] - w * WORD)) - 1)))
        return F.aggregate(zeros, F.lit(0), lambda x, y: x + y)

    return _let(F.split(short, ""), places)


def _tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, r"(?U)[\s\x1c-\x1f]+"), lambda t: t != ""))


def token_set_ratio(left: str, right: str, pairs: DataFrame, name: str) -> DataFrame:
    """UDF-01: adds the token-set ratio (0 to 100) of two text columns.

    Only what is left of two texts that are no subset of each other is compared by its longest common
    subsequence.
    """
    a, b = F.col("_a"), F.col("_b")
    common = F.array_intersect(a, b)
    rest = [F.array_join(F.array_sort(F.array_except(x, y)), " ") for x, y in ((a, b), (b, a))]
    parts = pairs.withColumns({"_a": _tokens(F.col(left)), "_b": _tokens(F.col(right))}).withColumns({
        "_common": F.length(F.array_join(common, " ")), "_sa": rest[0], "_sb": rest[1],
        "_fixed": F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).when(
            (F.size(common) > 0) & ((F.size(common) == F.size(a)) | (F.size(common) == F.size(b))), 100.0),
    }).drop("_a", "_b")
    decided = F.col("_fixed").isNotNull()
    shared, la, lb = F.col("_common"), F.length("_sa"), F.length("_sb")
    gap = F.when(shared > 0, 1).otherwise(0)

    def ratio(distance: Column, total: Column) -> Column:
        return F.when(total > 0, F.lit(100.0) - F.lit(100.0) * distance / total).otherwise(100.0)

    apart = ratio(la + lb - 2 * F.col("_lcs"), 2 * (shared + gap) + la + lb)
    with_shared = F.greatest(ratio(gap + la, 2 * shared + gap + la), ratio(gap + lb, 2 * shared + gap + lb))
    score = F.coalesce("_fixed", F.when(shared > 0, F.greatest(apart, with_shared)).otherwise(apart))
    lcs = F.when(decided, 0).otherwise(common_length(F.col("_sa"), F.col("_sb")))
    return parts.withColumn("_lcs", lcs).withColumn(name, score).drop("_common", "_sa", "_sb", "_fixed", "_lcs")


def _profiled(values: DataFrame, side: str) -> DataFrame:
    """Each text in column `value` with its tokens, its sorted text, its length, its numbers per group and its class."""
    tokens = _tokens(F.col("value"))
    text = F.array_join(F.array_sort(tokens), " ")
    counts = [F.length("_text") - F.length(F.translate("_text", g, "")) for g in GROUPS]
    rows = values.withColumn("_text", text).withColumns({"n": F.length("_text"), "_counts": F.array(*counts)})
    rows = rows.withColumn("counts", F.concat("_counts", F.array(F.col("n") - F.aggregate("_counts", F.lit(0), lambda x, y: x + y))))
    level = F.transform("counts", lambda c: sum((F.when(c > top, 1).otherwise(0) for top in LEVELS), F.lit(0)))
    return rows.select(F.col("value").alias(f"{side}_value"), F.array_distinct(F.transform(tokens, F.lower)).alias(f"{side}_tokens"),
                       F.col("_text").alias(f"{side}_text"), F.col("n").alias(f"{side}_n"), F.col("counts").alias(f"{side}_counts"),
                       F.array_join(level, ",").alias(f"{side}_class"))


def _classes(profiled: DataFrame, side: str) -> DataFrame:
    """The classes of one side: how many texts, their lengths, and the largest number per group."""
    highest = [F.max(F.col(f"{side}_counts")[g]) for g in range(len(GROUPS) + 1)]
    return profiled.groupBy(f"{side}_class").agg(
        F.count(F.lit(1)).alias(f"{side}_size"), F.min(f"{side}_n").alias(f"{side}_least"), F.max(f"{side}_n").alias(f"{side}_most"),
        F.array(*highest).alias(f"{side}_highest"))


def meeting_classes(left: DataFrame, right: DataFrame, floor: float) -> DataFrame:
    """(left_class, right_class, left_size, right_size) of classes whose texts can have a common part that reaches the floor.

    An interval join: a common part is no longer than the shorter text, so the longer one has at most
    (2 - floor) / floor times its length. Classes meet in bands of a geometric grid of lengths, each pair in the first band that both
    cover; a band is dealt to SPLIT tasks.
    """
    t = max(floor - SLACK, 0.0)
    reach = t / (2 - t)
    step = math.log(max(1 / reach, 1.25)) if reach > 0 else None

    def band(length: Column) -> Column:
        return F.floor(F.log(F.greatest(length.cast("double"), F.lit(1.0))) / step).cast("int") if step else F.lit(0)

    a, b = _classes(left, "left"), _classes(right, "right")
    a = a.withColumns({"_l0": band(F.col("left_least")), "_l1": band(F.col("left_most"))})
    # a hair wider than the exact bounds, which the condition below checks
    wide = 1 + 1e-9
    b = b.withColumns({"_r0": band(F.col("right_least") * (reach / wide)),
                       "_r1": band(F.col("right_most") * (wide / reach)) if step else F.lit(0)})
    a = a.withColumn("_band", F.explode(F.sequence("_l0", "_l1"))).withColumn("_part", F.pmod(F.xxhash64("left_class"), F.lit(SPLIT)))
    b = b.withColumn("_band", F.explode(F.sequence("_r0", "_r1"))).withColumn("_part", F.explode(F.sequence(_long(0), _long(SPLIT - 1))))
    common = F.aggregate(F.zip_with("left_highest", "right_highest", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    pairs = a.join(b, ["_band", "_part"]).filter(F.col("_band") == F.greatest("_l0", "_r0"))
    return pairs.filter(2 * common >= (F.col("left_least") + F.col("right_least")) * t - 1e-9).select(
        "left_class", "right_class", "left_size", "right_size")


def candidate_pairs(left: DataFrame, right: DataFrame, floor: float) -> tuple[DataFrame, DataFrame]:
    """Pairs of distinct texts that can reach the floor: those that share a token, and those that share none.

    Both inputs hold one column `value` of distinct non-blank texts. The first table holds left_value and right_value, the
    second the sorted texts left_text and right_text besides. No pair is in both, and none comes twice. Eager: profiles and
    meeting classes are stored and counted at once.
    """
    a, b = stage(_profiled(left, "left")), stage(_profiled(right, "right"))
    meeting = stage(meeting_classes(a, b, floor))
    words = [df.select(f"{s}_value", f"{s}_tokens", F.explode(f"{s}_tokens").alias("key")) for s, df in (("left", a), ("right", b))]
    of_left = meeting.groupBy("left_class").agg(F.max("left_size").alias("_texts"), F.count(F.lit(1)).alias("_met"))
    of_right = meeting.groupBy("right_class").agg(F.max("right_size").alias("_texts"), F.sum("left_size").alias("_met"))
    sizes = result_sizes({
        "token": (key_rows(words[0], ["key"]), key_rows(words[1], ["key"])),
        "left": tuple(key_rows(of_left, ["left_class"], F.col(c)) for c in ("_texts", "_met")),
        "right": tuple(key_rows(of_right, ["right_class"], F.col(c)) for c in ("_met", "_texts"))}, PAIR_ROWS)
    # a pair meets in every token it shares, and counts in the first
    shared = F.array_min(F.array_intersect("left_tokens", "right_tokens"))
    by_token = product_join(*words, ["key"], ["left_value"], PAIR_ROWS, sizes=sizes["token"]).filter(F.col("key") == shared)
    t = max(floor - SLACK, 0.0)
    reach = (F.col("left_n") + F.col("right_n")) * (t / 2) - 1e-9
    common = F.aggregate(F.zip_with("left_counts", "right_counts", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    met = product_join(a, meeting.select("left_class", "right_class"), ["left_class"], ["left_value"], PAIR_ROWS, sizes=sizes["left"])
    near = product_join(met, b, ["right_class"], ["left_value"], PAIR_ROWS, sizes=sizes["right"])
    apart = near.filter(common >= reach).filter(~F.arrays_overlap("left_tokens", "right_tokens"))
    return by_token.select("left_value", "right_value"), apart.select("left_value", "right_value", "left_text", "right_text")


def scored_pairs(left: DataFrame, right: DataFrame, floor: float) -> DataFrame:
    """RUL-12 over distinct texts: (left_value, right_value, score) with score >= floor."""
    sharing, apart = candidate_pairs(left, right, floor)
    # without a shared token the ratio is that of the two sorted texts; two texts without any token score nothing
    total = F.length("left_text") + F.length("right_text")
    lcs = common_length(F.col("left_text"), F.col("right_text"))
    ratio = F.lit(100.0) - F.lit(100.0) * (total - 2 * lcs) / total
    alone = apart.withColumn("score", F.when((F.length("left_text") > 0) & (F.length("right_text") > 0), ratio).otherwise(0.0))
    scored = token_set_ratio("left_value", "right_value", sharing, "score").unionByName(alone.drop("left_text", "right_text"))
    same = F.lower("left_value") == F.lower("right_value")
    score = F.array(F.struct(F.when(same, 1.0).otherwise(F.col("score") / 100.0).alias("score")))
    # as a generator, so that a score is computed once: a filter would be pushed down with a second copy of it
    return scored.select("left_value", "right_value", F.inline(F.filter(score, lambda s: s["score"] >= floor)))
