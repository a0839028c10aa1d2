"""N-gram Jaccard join: small sets enumerate subsets, large sets scan inverted lists.

Two sets of n and m shingles link when they share at least c(n, m) of them. Small sets write down all
their subsets of that size; sets that meet in one link. Enumeration explodes with the size, so sets
above a boundary, chosen by the cost of both ways, are found through inverted lists instead. A list's
entry is not a single shingle but a block: shingles are dealt by hash to more parts than two linked sets
can differ in, so at least one part agrees as a whole. Lists of blocks hold few sets that do not link,
where lists of common shingles would hold a good part of the corpus.

Linked sets agree in several blocks: a set that shares fewer lists with any others, as texts with a common
passage do, leaves at once. Every other set is compared with the first set of the lists it shares most often, so
thousands of near copies cost a comparison each. Sets that still have as many lists with several components as a
link needs get a second look: within a cluster of such sets, each is described by its difference from the shingles
that most of the cluster has. Those differences are small, and a prefix join over them, rare shingles first, finds the
remaining pairs. No link between components is lost.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from worklink.llm.common import Recent, id_and_text, released, stored
from worklink.llm.components import connected_components

LARGEST_SMALL = 32  # sizes up to this are weighed for the boundary
GROWTH = 1.5  # between the part counts of neighbouring size levels
ENTRIES = 200_000  # list entries that a task hands over at a time
BROADCAST_ROWS = 1_000_000  # of two numbers each; beyond, the join shuffles
ONE, TWO, BOTH = 0, 1, 2  # side of a list's entry: smaller size, larger size, any
#: Odd multipliers of the mixing steps.
MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def overlap(n: int, m: int, percent: int) -> int:
    """Smallest intersection of linked sets of n and m elements."""
    return -(-percent * (n + m) // (100 + percent))


def partners(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def difference(n: int, percent: int) -> int:
    """Most elements in which a set of n and a linked set of at most n can differ."""
    return 2 * n * (100 - percent) // (100 + percent)


def level(n: int, percent: int) -> int:
    """Number of the first level whose bound on the difference covers sets of n."""
    i = 0
    while bound(i) < difference(n, percent):
        i += 1
    return i


def bound(i: int) -> int:
    return math.ceil(GROWTH ** i) if i else 0


def parts(i: int) -> int:
    """Parts of a level: enough that a differing pair agrees in one, with room for empty parts."""
    return math.ceil(1.1 * (bound(i) + 1)) + 2


def enumerations(n: int, most: int, percent: int) -> int:
    """Subsets that a set of n writes down to meet all linked sets of at most `most`."""
    return sum(math.comb(n, overlap(n, m, percent)) for m in partners(n, percent) if m <= most)


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest size that enumerates, at the least total cost.

    A written subset costs one row. A scanned block costs one row too, and each set beyond the
    boundary the fetch and comparison of its shingles, taken as four rows per shingle.
    """
    def cost(x: int) -> float:
        total = 0.0
        for n, times in sizes.items():
            if n <= x:
                total += times * enumerations(n, x, percent)
            if n > x or 100 * n >= percent * (x + 1):
                total += times * (parts(level(n, percent)) + 4 * n)
        return total

    return min(range(LARGEST_SMALL + 1), key=lambda x: (cost(x), x))


def mixed(x: np.ndarray, step: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MULTIPLIERS[step]
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Sets of hashed word n-grams, and what a set is looked up by."""

    def __init__(self, words: int, percent: int, small: int = 0):
        self.words, self.percent, self.small = words, percent, small
        self.__setstate__(self.__dict__)

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("words", "percent", "small")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.hashes = Recent(xxh3_64_intdigest)
        self.levels: dict[int, range] = {}

    def shingles(self, text: str) -> np.ndarray:
        """Sorted hashes of the distinct n-grams; a text with fewer words is one n-gram as a whole."""
        found = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII letters and blanks only
        if not found:
            return np.zeros(0, np.uint64)
        ids = np.array([self.hashes[w] for w in found], np.uint64)
        width = min(self.words, len(ids))
        out = np.full(len(ids) - width + 1, width, np.uint64)
        for i in range(width):
            out = mixed(out * MULTIPLIERS[3] + ids[i:len(ids) - width + 1 + i], i % 3)
        return np.unique(out)

    @staticmethod
    def digest(s: np.ndarray) -> tuple[int, int]:
        """Two hashes of a set as signed numbers."""
        return tuple(int(mixed(s, i).sum(dtype=np.uint64).astype(np.int64)) for i in (0, 1))

    def list_levels(self, n: int) -> range:
        if n not in self.levels:
            if len(self.levels) > 100_000:
                self.levels.clear()
            # as the smaller or equal partner of sets beyond the boundary
            low, high = max(n, self.small + 1), max(n, 100 * n // self.percent)
            self.levels[n] = range(level(low, self.percent), level(high, self.percent) + 1) if low <= high else range(0)
        return self.levels[n]

    def entries(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List keys of a set, its side in each list, the list's level (-1: subsets), and the lists of that level that
        it shares at least with a linked set."""
        keys, sides, levels, least = [], [], [], []
        n = len(s)
        if 0 < n <= self.small:
            own = mixed(s, 1)
            for m in partners(n, self.percent):
                if m <= self.small:
                    low, high = min(n, m), max(n, m)
                    size = overlap(n, m, self.percent)
                    sums = np.array([own[list(c)].sum(dtype=np.uint64) for c in combinations(range(n), size)], np.uint64)
                    keys.append(mixed(sums + np.uint64(low * 1000 + high), 2))
                    sides.append(np.full(len(sums), BOTH if n == m else ONE if n < m else TWO, np.int8))
                    levels.append(np.full(len(sums), -1, np.int8))
                    least.append(np.ones(len(sums), np.int32))
        for i in self.list_levels(n) if n else ():
            p = parts(i)
            own = mixed(s, 2)
            part = ((own >> np.uint64(20)) % np.uint64(p)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            part = part[order]
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            sums = np.add.reduceat(mixed(s, 0)[order], first)
            filled = part[first]
            shared = len(filled) - bound(i)
            if len(filled) <= bound(i):  # so few filled parts that an empty one may be all that agrees
                empty = np.setdiff1d(np.arange(p), filled)
                filled, sums = np.r_[filled, empty], np.r_[sums, np.zeros(len(empty), np.uint64)]
            keys.append(mixed(sums + filled.astype(np.uint64) * MULTIPLIERS[0] + np.uint64(1_000_000 + i), 1))
            sides.append(np.full(len(sums), BOTH, np.int8))
            levels.append(np.full(len(sums), i, np.int8))
            least.append(np.full(len(sums), shared, np.int32))
        if not keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros(0, np.int8), np.zeros(0, np.int32)
        return np.concatenate(keys).astype(np.int64), np.concatenate(sides), np.concatenate(levels), np.concatenate(least)


def sets_of(docs: DataFrame, shingler: Shingler) -> DataFrame:
    """(doc_id, n, h1, h2): the size of every document's set and two hashes that stand for it."""
    shared = docs.sparkSession.sparkContext.broadcast(shingler)

    def run(batches):
        for batch in batches:
            n, h1, h2 = [], [], []
            for text in batch.column(1).to_pylist():
                s = shared.value.shingles(text)
                a, b = shared.value.digest(s)
                n.append(len(s))
                h1.append(a)
                h2.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, h1, h2))], names=["doc_id", "n", "h1", "h2"])

    return docs.mapInArrow(run, "doc_id long, n long, h1 long, h2 long")


def list_entries(docs: DataFrame, shingler: Shingler) -> DataFrame:
    """(key, h1, side, level, least): a set's entries in subset and block lists, once per task."""
    shared = docs.sparkSession.sparkContext.broadcast(shingler)
    names = ["key", "side", "level", "least", "h1"]

    def run(batches):
        seen: set[int] = set()

        def rows(found):
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=names)

        for batch in batches:
            found, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = shared.value.shingles(text)
                h1 = shared.value.digest(s)[0]
                if doc_id is None or not len(s) or h1 in seen:
                    continue
                seen.add(h1)
                entries = shared.value.entries(s)
                found.append((*entries, np.full(len(entries[0]), h1, np.int64)))
                held += len(entries[0])
                if held > ENTRIES:
                    yield rows(found)
                    found, held = [], 0
            if found:
                yield rows(found)

    return docs.mapInArrow(run, "key long, side byte, level byte, least int, h1 long")


def fetch_sets(nodes: DataFrame, reps: DataFrame, docs: DataFrame, shingler: Shingler) -> DataFrame:
    """(h1, rep, data) of the sets named in column `h1`, from the texts of their representatives.

    The texts wanted are few next to the corpus, so their ids are broadcast while their number is small; otherwise the
    join shuffles.
    """
    wanted = stored(nodes.join(reps, "h1").select(F.col("rep").alias("doc_id"), F.col("h1").alias("want")).distinct(), "wanted")
    few = wanted.count() <= BROADCAST_ROWS
    texts = docs.join(F.broadcast(wanted) if few else wanted, "doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(shingler)

    def fetch(batches):
        for batch in batches:
            rows = []
            for doc_id, text, want in zip(*(c.to_pylist() for c in batch.columns)):
                s = shared.value.shingles(text)
                if shared.value.digest(s)[0] == want:  # an id may stand for several texts
                    rows.append((want, doc_id, s.tobytes()))
            h1, rep, data = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1, pa.int64()), pa.array(rep, pa.int64()), pa.array(data, pa.binary())], names=["h1", "rep", "data"])

    return stored(texts.select("doc_id", "text", "want").mapInArrow(fetch, "h1 long, rep long, data binary"), "sets")


def compare(pairs: DataFrame, reps: DataFrame, docs: DataFrame, shingler: Shingler) -> DataFrame:
    """(rep_a, rep_b, n_a, n_b, common) of pairs of sets (a, b).

    Only the second set of a pair moves with it: a first set that thousands are compared with moves once.
    """
    nodes = pairs.select(F.col("a").alias("h1")).union(pairs.select(F.col("b").alias("h1"))).distinct()
    sets = fetch_sets(nodes, reps, docs, shingler)

    def count(batches):
        for batch in batches:
            out = []
            held, first = None, None
            for a, rep_a, rep_b, left, right in zip(*(c.to_pylist() for c in batch.columns)):
                if held != (a, rep_a):
                    held, first = (a, rep_a), np.frombuffer(left, np.uint64)
                second = np.frombuffer(right, np.uint64)
                at = np.minimum(np.searchsorted(first, second), len(first) - 1)
                out.append((rep_a, rep_b, len(first), len(second), int((first[at] == second).sum())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 5)], names=["rep_a", "rep_b", "n_a", "n_b", "common"])

    second = sets.select(F.col("h1").alias("b"), F.col("rep").alias("rep_b"), F.col("data").alias("data_b"))
    first = sets.select(F.col("h1").alias("a"), F.col("rep").alias("rep_a"), F.col("data").alias("data_a"))
    both = pairs.join(second, "b").join(first, "a").select("a", "rep_a", "rep_b", "data_a", "data_b")
    return both.mapInArrow(count, "rep_a long, rep_b long, n_a long, n_b long, common long")


def linked(percent: int):
    return F.col("common") * (100 + percent) >= F.lit(percent) * (F.col("n_a") + F.col("n_b"))


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id for every document.

    Words are what lies between ASCII blanks, in lower case (A to Z only). Documents link when their sets of `words`-word
    shingles have 100 * intersection >= `percent` * union. A null, empty or blank text has an empty set and links with
    nothing; a text of fewer words is one shingle. component_id is the smallest doc_id reachable by links. Copies are
    compared as one. A null id stays null and links with nothing; rows that share an id are one document in the
    graph. An empty table gives no rows; other columns are not read. Shingles are told apart by a
    64-bit hash. Eager: all but the last join runs at once.
    """
    spark = docs.sparkSession
    source = id_and_text(docs, id_col, text_col)
    sets = stored(sets_of(source, Shingler(words, percent)), "sets")
    some = sets.filter("n > 0 and doc_id is not null")
    reps = stored(some.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n")), "reps")
    sizes = {r.n: r.times for r in reps.filter(F.col("n") <= LARGEST_SMALL).groupBy("n").agg(F.count(F.lit(1)).alias("times")).collect()}
    shingler = Shingler(words, percent, boundary(sizes, percent))

    entries = stored(shared_lists(list_entries(source, shingler)).distinct(), "entries")
    lists = stored(with_pivots(shared_lists(hopeful(entries))), "lists")
    released(entries)

    def edges_of(found: DataFrame) -> DataFrame:
        return found.filter(linked(percent)).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))

    first = stored(first_pairs(lists), "pairs")
    edges = stored(edges_of(compare(first, reps, source, shingler)), "links")
    released(first)
    components = connected_components(edges)
    clusters = connected_components(open_sets(lists, reps, components))
    released(lists)
    if not clusters.isEmpty():
        around = stored(differences(clusters, fetch_sets(clusters.select(F.col("node").alias("h1")), reps, source, shingler)), "around")
        # sets that link by their sizes alone are one component before the others are sought
        edges = edges.unionByName(stored(links_by_size(around, percent), "links"))
        before, components = components, connected_components(edges)
        rest = stored(pairs_by_differences(around, components, percent), "rest")
        released(before, around)
        more = stored(edges_of(compare(rest, reps, source, shingler)), "links")
        before, components = components, connected_components(edges.unionByName(more))
        released(before, rest, more)

    of_set = reps.join(components.withColumnRenamed("node", "rep"), "rep", "left").select(
        "h1", "h2", F.coalesce("component", "rep").alias("component_id"))
    found = sets.join(of_set, ["h1", "h2"], "left")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, without those that a component's smallest id stands for.

    Of rows that share an id the one with the smallest text stays. Rows without an id all stay.
    """
    found = stored(jaccard_components(docs, words, percent, id_col, text_col).select("doc_id", "component_id"), "components")

    def without(rows: DataFrame, ids: DataFrame, how: str = "left_anti") -> DataFrame:
        few = ids.count() <= BROADCAST_ROWS
        return rows.join(F.broadcast(ids) if few else ids, rows[id_col].cast("long") == ids["gone"], how)

    gone = stored(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct(), "gone")
    kept = without(docs, gone)
    repeated = stored(found.filter("doc_id = component_id").groupBy(F.col("doc_id").alias("gone")).count().filter("count > 1").select("gone"), "repeated")
    if repeated.isEmpty():
        return kept
    order = [text_col, *[c for c in docs.columns if c != text_col]]
    first = without(kept, repeated, "left_semi").groupBy(F.col(id_col).alias("_id")).agg(F.min(F.struct(*order)).alias("_row"))
    return without(kept, repeated).unionByName(first.select(*[F.col(f"_row.{c}").alias(c) for c in docs.columns]))


def shared_lists(entries: DataFrame) -> DataFrame:
    """The entries of lists that hold more than one set."""
    of_list = Window.partitionBy("key")
    ends = entries.withColumns({"first": F.min("h1").over(of_list), "last": F.max("h1").over(of_list)})
    return ends.filter("first <> last").drop("first", "last")


def hopeful(entries: DataFrame) -> DataFrame:
    """Without the entries of sets that share too few lists of a level with any others to link with one."""
    times = F.count(F.lit(1)).over(Window.partitionBy("h1", "level"))
    return entries.withColumn("times", times).filter("times >= least").drop("times")


def with_pivots(entries: DataFrame) -> DataFrame:
    """Each list's first set, for subset lists the first of the other side, where there is one."""
    of_list = Window.partitionBy("key")
    first = {s: F.min(F.when(F.col("side") == s, F.col("h1"))).over(of_list) for s in (ONE, TWO, BOTH)}
    pivot = F.when(F.col("side") == ONE, first[TWO]).when(F.col("side") == TWO, first[ONE]).otherwise(first[BOTH])
    return entries.withColumn("pivot", pivot).filter("pivot is not null")


def first_pairs(lists: DataFrame) -> DataFrame:
    """Pairs (a, b): of subset lists all with the first set, else each set with the pivot it shares most lists with."""
    others = lists.filter("h1 <> pivot")
    certain = others.filter("level < 0").select(F.col("pivot").alias("a"), F.col("h1").alias("b"))
    often = others.filter("level >= 0").groupBy("h1", "pivot").agg(F.count(F.lit(1)).alias("times"))
    most = often.groupBy("h1").agg(F.max(F.struct("times", "pivot")).alias("m"))
    return certain.union(most.select(F.col("m.pivot").alias("a"), F.col("h1").alias("b"))).distinct()


def open_sets(lists: DataFrame, reps: DataFrame, components: DataFrame) -> DataFrame:
    """Pairs (a, b) of a pivot and a set of its lists that may still link with a set of another component.

    A list is settled if it holds one component. A set shares at least `least` lists of a level with every set it
    links with there. If fewer of its lists are unsettled, each of those sets meets it in a settled one.
    """
    of_node = reps.join(components.withColumnRenamed("node", "rep"), "rep", "left").groupBy("h1").agg(
        F.min(F.coalesce("component", "rep")).alias("component"))
    entries = lists.filter("level >= 0").select("key", "h1", "level", "least", "pivot").join(of_node, "h1")

    def several(rows: DataFrame) -> DataFrame:
        ends = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        return rows.join(ends.filter("low <> high").select("key"), "key")

    unsettled = stored(several(entries), "unsettled")
    often = unsettled.groupBy("h1", "level").agg(F.count(F.lit(1)).alias("times"))
    left = several(unsettled.join(often, ["h1", "level"]).filter("times >= least"))
    return left.filter("h1 <> pivot").select(F.col("pivot").alias("a"), F.col("h1").alias("b")).distinct()


def differences(clusters: DataFrame, sets: DataFrame) -> DataFrame:
    """(cluster, s, rep, n, far, diff): how each set differs from what more than half of its cluster's sets hold."""
    members = sets.join(clusters.select(F.col("node").alias("h1"), F.col("component").alias("cluster")), "h1")

    def elements(batches):
        for batch in batches:
            data = [np.frombuffer(d, np.int64) for d in batch.column(1).to_pylist()]
            owner = np.repeat(batch.column(0).to_numpy(), [len(d) for d in data])
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner, pa.int64()), pa.array(np.concatenate(data) if data else [], pa.int64())], names=["cluster", "element"])

    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    times = members.select("cluster", "data").mapInArrow(elements, "cluster long, element long").groupBy(
        "cluster", "element").agg(F.count(F.lit(1)).alias("times"))
    # at most twice as many as a set of the cluster holds on average
    middle = times.join(sizes, "cluster").filter(F.col("times") * 2 > F.col("size")).groupBy("cluster").agg(
        F.sort_array(F.collect_list("element")).alias("middle"))

    def differ(batches):
        for batch in batches:
            own = [np.frombuffer(d, np.int64) for d in batch.column(3).to_pylist()]
            # the cluster's elements stay one array: as Python numbers they would take five times the memory
            common = batch.column(4)
            values, ends = common.values.to_numpy(zero_copy_only=False), common.offsets.to_numpy()
            diff = [np.setxor1d(d, values[i:j], assume_unique=True) for d, i, j in zip(own, ends[:-1], ends[1:])]
            far = [len(d) for d in diff]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *far]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *diff])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(d) for d in own], pa.int64()), pa.array(far, pa.int64()), lists],
                names=["cluster", "s", "rep", "n", "far", "diff"])

    return members.join(middle, "cluster", "left").select("cluster", "h1", "rep", "data", "middle").mapInArrow(
        differ, "cluster long, s long, rep long, n long, far long, diff array<long>")


def links_by_size(around: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of sets whose differences R and S are so small that they link without anything in common.

    That is |R| + |S| <= x (n_r + n_s): with the set of the cluster that has the smallest |S| - x n, both link too.
    """
    weight = F.col("far") * (100 + percent) - F.col("n") * (100 - percent)
    rows = around.select("cluster", "rep", weight.alias("weight"))
    nearest = rows.groupBy("cluster").agg(F.min(F.struct("weight", "rep")).alias("m"))
    both = rows.join(nearest, "cluster").filter((F.col("weight") + F.col("m.weight") <= 0) & (F.col("rep") != F.col("m.rep")))
    return both.select(F.col("m.rep").alias("a"), F.col("rep").alias("b"))


def pairs_by_differences(around: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets of different components of a cluster that may link and have differences in common.

    Two sets with the differences R and S differ from each other in |R| + |S| - 2 |R and S| shingles and link if that is
    at most x (n_r + n_s), with x = (1 - t) / (1 + t). So R and S need an overlap of (|R| + |S| - x (n_r + n_s)) / 2
    elements; in a common order they share one that has at least as many elements from itself to the end on both
    sides. Elements that occur once in a cluster come first and join nothing.
    """
    x = (100 - percent) / (100 + percent)
    own = components.withColumnsRenamed({"node": "rep", "component": "found"})
    known = around.join(own, "rep", "left").withColumn("component", F.coalesce("found", "rep")).drop("found")
    several = known.groupBy("cluster").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    known = stored(known.join(several.select("cluster"), "cluster"), "known")
    elements = known.select("cluster", "s", F.explode("diff").alias("element"))
    often = elements.groupBy("cluster", "element").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    shared = elements.join(often, ["cluster", "element"])
    of_set = Window.partitionBy("cluster", "s")
    place = F.row_number().over(of_set.orderBy("times", "element"))
    placed = shared.withColumns({"place": place, "held": F.count(F.lit(1)).over(of_set)}).join(
        known.select("cluster", "s", "component", "n", "far"), ["cluster", "s"])
    # elements from this one to the end, this one included
    ahead = F.col("held") - F.col("place") + 1
    least = F.greatest(F.lit(1.0), F.col("far") - F.lit(x) * (F.col("n") + F.floor(F.col("n") * 100 / percent)) - 1e-9)
    rows = placed.withColumn("ahead", ahead).filter(F.col("ahead") >= least).select(
        "cluster", "element", "s", "component", "n", "far", "ahead")
    other = rows.select("cluster", "element", *[F.col(c).alias(f"{c}_2") for c in ("s", "component", "n", "far", "ahead")])
    sizes = F.least("n", "n_2") * 100 >= F.greatest("n", "n_2") * percent
    need = (F.col("far") + F.col("far_2") - F.lit(x) * (F.col("n") + F.col("n_2"))) / 2 - 1e-9
    # pairs that need nothing in common are linked by their sizes already
    some = (F.col("far") + F.col("far_2")) * (100 + percent) > (F.col("n") + F.col("n_2")) * (100 - percent)
    fits = (F.col("s") < F.col("s_2")) & (F.col("component") != F.col("component_2")) & sizes & some & (F.least("ahead", "ahead_2") >= need)
    found = rows.join(other, ["cluster", "element"]).filter(fits)
    return found.select(F.col("s").alias("a"), F.col("s_2").alias("b")).distinct()
