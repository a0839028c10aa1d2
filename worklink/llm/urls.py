"""URL filtering: rules first, then the ratio of two character language models.

Variable-order Markov models of accepted and of rejected URLs predict each byte from up to five before
it, every order smoothed by the one below (Witten-Bell). Where no rule fits, a URL is judged by the
difference of its log-likelihoods per byte against a threshold calibrated on URLs kept out of training.

The models are tables: what both give a byte depends on it and the five before, so there is a row for each six
bytes that occur, and its probabilities come from the counts of its shorter endings, order by order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from worklink.llm.common import released, stored
from worklink.operators.keyed import ranked, skew_join

ORDER = 5
SHARE = 5  # every so many-th URL of a verdict is kept out of training and calibrates
TABLE_ROWS = 2_000_000  # grams that a broadcast holds (16 bytes each)
TASK_GRAMS = 500_000  # grams that a task adds up before it hands them on
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str, str]  # host, path, verdict


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty where there is no `://`."""
    rest = F.when(url.contains("://"), F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), CAPITALS, SMALL)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, outcome in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text, verdict = F.when(fits, rule_host + rule_path).otherwise(text), F.when(fits, outcome).otherwise(verdict)
    return text, verdict


def grams(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of framed URLs as one array and the positions to predict: each byte and the end."""
    framed = b"".join(b"\0" * ORDER + u + b"\n" for u in urls)
    lengths = np.array([len(u) + ORDER + 1 for u in urls], np.int64)
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(urls)), lengths)
    place = np.arange(len(framed)) - starts[owner]
    at = np.flatnonzero(place >= ORDER)
    return np.frombuffer(framed, np.uint8).astype(np.uint64), at


def code(raw: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """A byte with `order` bytes before it as one number; the byte itself is the lowest."""
    out = raw[at].copy()
    for back in range(1, order + 1):
        out |= raw[at - back] << np.uint64(8 * back)
    return out


class MarkovModel:
    """Counts of all orders as sorted arrays, in one process."""

    def __init__(self, urls: list[bytes]):
        raw, at = grams(urls)
        self.tables = []
        for order in range(ORDER + 1):
            keys, n = np.unique(code(raw, at, order), return_counts=True)
            context, first, kinds = np.unique(keys >> np.uint64(8), return_index=True, return_counts=True)
            size = np.add.reduceat(n, first) if len(n) else n
            self.tables.append((keys, n.astype(np.int32), context, size.astype(np.int32), kinds.astype(np.int32)))

    @staticmethod
    def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(wanted))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], 0).astype(np.float64)

    def logs(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log probability of each byte; an unseen context leaves the shorter one's."""
        p = np.full(len(at), 1 / 256)
        for order, (keys, n, context, size, kinds) in enumerate(self.tables):
            gram = code(raw, at, order)
            total, different = self._look(context, size, gram >> np.uint64(8)), self._look(context, kinds, gram >> np.uint64(8))
            p = np.where(total > 0, (self._look(keys, n, gram) + different * p) / np.maximum(total + different, 1), p)
        return np.log(p)


class UrlFilter:
    """Both models and the threshold on their difference, in one process: what `filter_urls` gives, for few URLs."""

    def __init__(self, accepted: list[bytes], rejected: list[bytes], share: int = SHARE):
        """Every `share`-th URL of each side is kept out of training and calibrates."""
        train = [[u for i, u in enumerate(side) if i % share or len(side) < 2] for side in (accepted, rejected)]
        self.models = [MarkovModel(side) for side in train]
        self.known = [bool(accepted), bool(rejected)]
        good, bad = (self.scores([u for i, u in enumerate(side) if i % share == 0]) for side in (accepted, rejected))
        self.threshold = 0.0
        if len(good) and len(bad):
            # the cut with the best mean of both sides' accuracies, in the middle of its gap
            cuts = np.unique(np.concatenate([good, bad]))
            cuts = np.concatenate([[cuts[0] - 1], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1]])
            kept = 1 - np.searchsorted(np.sort(good), cuts) / len(good)
            dropped = np.searchsorted(np.sort(bad), cuts) / len(bad)
            self.threshold = float(cuts[int(np.argmax(kept + dropped))])

    def scores(self, urls: list[bytes]) -> np.ndarray:
        """Log-likelihood difference per byte, the end included."""
        if not urls:
            return np.zeros(0)
        raw, at = grams(urls)
        lengths = np.array([len(u) + 1 for u in urls])
        first = np.cumsum(lengths) - lengths
        return np.add.reduceat(self.models[0].logs(raw, at) - self.models[1].logs(raw, at), first) / lengths

    def verdicts(self, scores: np.ndarray) -> np.ndarray:
        if not all(self.known):  # nothing to compare with: only a one-sided experience counts
            return np.full(len(scores), "block" if self.known[1] else "allow")
        return np.where(scores >= self.threshold, "allow", "block")


def plain(url: str | None) -> bytes:
    return (url or "").encode("utf-8", "surrogatepass").lower()


def _gram_rows(batches, hit: int, allow: int, block: int):
    """Grams of the URLs in the first column, added up within a task as far as TASK_GRAMS allow."""
    def rows(keys, n):
        kinds = [pa.array(n * times, pa.int64()) for times in (hit, allow, block)]
        return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), *kinds], names=["gram", "hits", "allow", "block"])

    keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        urls = [plain(u) for u in batch.column(0).to_pylist()]
        for i in range(0, len(urls), 1000):
            raw, at = grams(urls[i:i + 1000])
            more, times = np.unique(code(raw, at, ORDER), return_counts=True)
            keys, where = np.unique(np.concatenate([keys, more]), return_inverse=True)
            n = np.bincount(where, np.concatenate([n, times])).astype(np.int64)
            if len(keys) > TASK_GRAMS:
                yield rows(keys, n)
                keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(keys):
        yield rows(keys, n)


def _counted(urls: DataFrame, hit: int, allow: int, block: int) -> DataFrame:
    return urls.mapInArrow(lambda batches: _gram_rows(batches, hit, allow, block), "gram long, hits long, allow long, block long")


def gram_models(counts: DataFrame) -> DataFrame:
    """(gram, hits, p_allow, p_block) of (gram, hits, allow, block): both models' probability of a gram's last byte.

    Grams of a shorter order are endings of longer ones, so their counts are sums. A context has at most 256
    grams and an ending at most 256 longer ones, so no key is hot.
    """
    def low(order: int):
        return F.col("gram").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1).cast("long"))

    sides = ("allow", "block")
    sums = [F.sum(c).alias(c) for c in ("hits", *sides)]
    levels = [counts]
    for order in range(ORDER - 1, -1, -1):
        levels.insert(0, levels[0].groupBy(low(order).alias("gram")).agg(*sums))
    found = None
    for order, level in enumerate(levels):
        level = level.withColumn("context", F.shiftrightunsigned("gram", 8))
        contexts = level.groupBy("context").agg(
            *[F.sum(c).alias(f"total_{c}") for c in sides], *[F.count_if(F.col(c) > 0).alias(f"kinds_{c}") for c in sides])
        level = level.join(contexts, "context")
        if order == 0:
            level = level.withColumns({f"p_{c}": F.lit(1 / 256) for c in sides})
        else:
            level = level.withColumn("ending", low(order - 1)).join(found.withColumnRenamed("gram", "ending").drop("hits"), "ending")
        found = level.select("gram", "hits", *[
            F.when(F.col(f"total_{c}") > 0, (F.col(c) + F.col(f"kinds_{c}") * F.col(f"p_{c}")) / (F.col(f"total_{c}") + F.col(f"kinds_{c}")))
            .otherwise(F.col(f"p_{c}")).alias(f"p_{c}") for c in sides])
    return found


def _with_logs(models: DataFrame) -> DataFrame:
    """(gram, hits, gain): the difference of both models' log probabilities."""
    def run(batches):
        for batch in batches:
            allow, block = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.log(allow) - np.log(block))], names=["gram", "hits", "gain"])

    return models.mapInArrow(run, "gram long, hits long, gain double")


def _least_hits(gains: DataFrame, table_rows: int) -> int:
    """The hits from which on grams are frequent, so that at most `table_rows` are; 0 where all are."""
    left, least = table_rows, None
    for row in gains.groupBy("hits").count().orderBy(F.desc("hits")).toLocalIterator():
        left -= row["count"]
        if left < 0:
            return row["hits"] + 1 if least is None else least
        least = row["hits"]
    return 0


def _gains(urls: list[bytes], keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each URL's gain from the grams in `keys`, and the other grams with the number of their URL."""
    raw, at = grams(urls)
    wanted = code(raw, at, ORDER)
    lengths = np.array([len(u) + 1 for u in urls])
    place = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    here = keys[place] == wanted if len(keys) else np.zeros(len(wanted), bool)
    gain = np.where(here, values[place], 0) if len(keys) else np.zeros(len(wanted))
    other = np.flatnonzero(~here)
    return np.add.reduceat(gain, np.cumsum(lengths) - lengths), np.repeat(np.arange(len(urls)), lengths)[other], wanted[other]


class UrlScores:
    """Scores of URLs: the gains of frequent grams are broadcast, rare grams, where there are any, meet theirs in a join."""

    def __init__(self, gains: DataFrame, table_rows: int = TABLE_ROWS):
        least = _least_hits(gains, table_rows)
        frequent = gains.filter(F.col("hits") >= least).select("gram", "gain").toArrow()
        keys, values = frequent.column(0).to_numpy().astype(np.uint64), frequent.column(1).to_numpy()
        order = np.argsort(keys)
        self.table = gains.sparkSession.sparkContext.broadcast((keys[order], values[order]))
        self.rare = gains.filter(F.col("hits") < least).select("gram", "gain") if least else None

    def add(self, rows: DataFrame) -> DataFrame:
        """Adds `score`, the log-likelihood difference per byte with the end included, to rows with a `url` that is not null."""
        table, place = self.table, rows.columns.index("url")

        def whole(batches):
            for batch in batches:
                scores = []
                for i in range(0, batch.num_rows, 1000):
                    urls = [plain(u) for u in batch.column(place).slice(i, 1000).to_pylist()]
                    scores.append(_gains(urls, *table.value)[0] / np.array([len(u) + 1 for u in urls]))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.concatenate([*scores, np.zeros(0)]))], names=[*batch.schema.names, "score"])

        def pieces(batches):
            """A row for the frequent grams of a URL (gram -1), and one for each rare gram in it."""
            for batch in batches:
                for i in range(0, batch.num_rows, 1000):
                    sums, owner, gram = _gains([plain(u) for u in batch.column(0).slice(i, 1000).to_pylist()], *table.value)
                    ids = batch.column(1).slice(i, 1000).to_numpy()
                    values = [np.concatenate([ids, ids[owner]]), np.concatenate([np.full(len(ids), -1), gram.astype(np.int64)]),
                              np.concatenate([sums, np.zeros(len(gram))])]
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=["url_id", "gram", "gain"])

        if self.rare is None:
            return rows.mapInArrow(whole, StructType([*rows.schema.fields, StructField("score", DoubleType())]))
        texts = stored(rows.select("url").distinct().withColumn("url_id", F.monotonically_increasing_id()), "url_texts")
        found = stored(texts.mapInArrow(pieces, "url_id long, gram long, gain double"), "url_pieces")
        met = found.filter("gram >= 0").drop("gain").join(self.rare, "gram").select("url_id", "gain")
        sums = found.filter("gram < 0").select("url_id", "gain").unionByName(met).groupBy("url_id").agg(F.sum("gain").alias("score"))
        scored = texts.join(sums, "url_id").select("url", (F.col("score") / (F.octet_length("url") + 1)).alias("score"))
        return skew_join(rows, scored, ["url"]).select(*rows.columns, "score")


def best_cut(held: DataFrame, sizes: dict[str, int]) -> float:
    """The score with the best mean of both verdicts' accuracies on (outcome, score), in the middle of its gap; the first on ties."""
    steps = held.groupBy("score").agg(*[F.count_if(F.col("outcome") == c).alias(c) for c in sizes])
    steps = stored(steps.repartitionByRange("score").withColumn("_range", F.spark_partition_id()), "url_cuts")
    sums = steps.groupBy("_range").agg(*[F.sum(c).alias(c) for c in sizes], F.max("score").alias("score")).orderBy("_range").collect()
    before, seen, last = [], dict.fromkeys(sizes, 0), None
    for row in sums:
        before.append((row["_range"], *seen.values(), last))
        seen, last = {c: n + row[c] for c, n in seen.items()}, row["score"]
    starts = steps.sparkSession.createDataFrame(before, "_range int, _allow long, _block long, _last double")
    own = Window.partitionBy("_range").orderBy("score")
    below = {c: F.coalesce(F.sum(c).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col(f"_{c}") for c in sizes}
    previous = F.coalesce(F.lag("score").over(own), "_last")
    mean = 1 - below["allow"] / F.lit(float(sizes["allow"])) + below["block"] / F.lit(float(sizes["block"]))
    cuts = steps.join(F.broadcast(starts), "_range").select(
        mean.alias("mean"), F.coalesce((F.col("score") + previous) / 2, F.col("score") - 1).alias("cut"))
    found = cuts.orderBy(F.desc("mean"), "cut").first().cut
    released(steps)
    return float(found)


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", table_rows: int = TABLE_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict and score for every page.

    URLs that a rule judges are the labelled ones: by the order of a hash every SHARE-th different URL of a verdict
    calibrates, all others train the models; every URL is scored. A broadcast holds at most `table_rows` grams, the most
    frequent ones; rarer grams, where there are more, meet their counts in a join. A null URL or one without `://` has empty host and path and is
    judged by the models (a null one as empty). Without URLs of one verdict the other is given. Repeated
    rows are judged once each, ties at the threshold are allowed, other columns are not read. Eager: the models
    are counted at once.
    """
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    host, path = url_parts(F.col("url"))
    judged = source.withColumns({"host": host, "path": path})
    rule, outcome = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": rule, "outcome": outcome, "url": F.coalesce("url", F.lit(""))})
    known = stored(ranked(judged.filter(F.col("outcome").isNotNull()).select("outcome", "url").distinct(),
                          ["outcome"], [F.xxhash64("url"), F.col("url")]), "url_known")
    sizes = {"allow": 0, "block": 0} | {r.outcome: r["count"] for r in known.groupBy("outcome").count().collect()}
    place, single = (F.col("rank") - 1) % SHARE, F.lit(False)
    for side, n in sizes.items():
        single = single | (F.col("outcome") == side) if n == 1 else single
    train, held = known.filter((place > 0) | single).select("url", "outcome"), known.filter(place == 0).select("outcome", "url")
    counts = _counted(judged.select("url"), 1, 0, 0)
    for side, kind in (("allow", (0, 1, 0)), ("block", (0, 0, 1))):
        counts = counts.unionByName(_counted(train.filter(F.col("outcome") == side).select("url"), *kind))
    counts = stored(counts.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("hits", "allow", "block")]), "url_grams")
    scores = UrlScores(stored(_with_logs(gram_models(counts)), "url_gains"), table_rows)
    threshold = 0.0
    if all(sizes.values()):
        marked = stored(scores.add(held), "url_held")
        threshold = best_cut(marked, {c: -(-n // SHARE) for c, n in sizes.items()})
        judgement = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    else:  # nothing to compare with: only a one-sided experience counts
        judgement = F.lit("block" if sizes["block"] else "allow")
    return scores.add(judged).select("page_id", "host", "path", "rule", F.coalesce("outcome", judgement).alias("verdict"), "score")
