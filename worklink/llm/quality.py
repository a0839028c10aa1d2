"""Quality classification by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded from how its kinds of characters follow
each other; a gated attention, learned from document labels alone, says how much each passage counts;
the weighted mean of the encodings is scored. All passages of a text take part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklink.llm.common import crc_mod, id_and_text, keep_rows, text_bytes

PASSAGE = 512  # bytes
ODD = 0x9E3779B97F4A7C15  # base of the word hash
PART = 1 << 22  # bytes encoded at a time
#: Kinds of bytes: small and capital letters, digits, blank, line break, and groups of signs;
#: then bytes of other alphabets, and the rest.
KINDS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r",
         b".,;:", b"'\"`", b"!?", b"#$%&*@^~", b"|<>{}[]()=+/\\_-", bytes(range(128, 256))]
N_KINDS = len(KINDS) + 1
PAIRS = N_KINDS * N_KINDS
FEATURES = PAIRS + 1  # kinds that follow each other, and words that repeat the one before
BLANKS = (3, 4)


def kind_table() -> np.ndarray:
    table = np.full(256, len(KINDS), np.int32)
    for kind, members in enumerate(KINDS):
        table[list(members)] = kind
    return table


TABLE = kind_table()


def encode_passages(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and features of each passage: square roots of shares.

    Shares of neighbouring kinds of bytes among all neighbours, and of words equal to the word before
    among all words. A passage is PASSAGE bytes, a text's last one may be shorter; an empty text is one empty passage.
    """
    lengths = np.diff(offsets)
    pieces = np.maximum(1, -(-lengths // PASSAGE))
    owner = np.repeat(np.arange(len(lengths)), pieces)
    first = np.cumsum(pieces) - pieces
    starts = offsets[:-1][owner] + (np.arange(len(owner)) - first[owner]) * PASSAGE
    ends = np.minimum(starts + PASSAGE, offsets[1:][owner])
    kinds = TABLE[raw]
    pairs = kinds[:-1] * N_KINDS + kinds[1:]
    passage = np.repeat(np.arange(len(owner)), ends - starts)
    inside = passage[:-1] == passage[1:]
    counts = np.bincount(passage[:-1][inside] * PAIRS + pairs[inside], minlength=len(owner) * PAIRS)
    counts = counts.reshape(len(owner), PAIRS).astype(np.float64)
    words, repeated = word_repeats(raw, kinds, passage, len(owner))
    shares = [counts / np.maximum(counts.sum(axis=1, keepdims=True), 1), (repeated / np.maximum(words, 1))[:, None]]
    return owner, np.sqrt(np.concatenate(shares, axis=1))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2... modulo 2^64."""
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors)


def word_repeats(raw: np.ndarray, kinds: np.ndarray, passage: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words per passage, and how many equal the word before, by their length and a hash of all their bytes.

    The hash of a word is the sum of its bytes times powers of an odd number modulo 2^64, a difference of running
    sums, with the power of its place divided out.
    """
    blank = np.isin(kinds, BLANKS)
    fresh = np.r_[True, passage[1:] != passage[:-1]] if len(raw) else np.zeros(0, bool)
    starts = np.flatnonzero(~blank & (fresh | np.r_[True, blank[:-1]][:len(raw)]))
    stops = np.flatnonzero(~blank & np.r_[fresh[1:] | blank[1:], np.ones(min(1, len(raw)), bool)])
    lengths = stops - starts + 1
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(ODD, len(raw)), out=sums[1:])
    mark = (sums[stops + 1] - sums[starts]) * powers(pow(ODD, -1, 1 << 64), len(raw))[starts]
    of = passage[starts]
    same = (mark[1:] == mark[:-1]) & (lengths[1:] == lengths[:-1]) & (of[1:] == of[:-1])
    return np.bincount(of, minlength=n), np.bincount(of[1:][same], minlength=n)


def parts(raw: np.ndarray, offsets: np.ndarray):
    """Cut a batch into parts of about PART bytes at passage borders: (first text, bytes, offsets)."""
    n = len(offsets) - 1
    i, start = 0, int(offsets[0])
    while i < n:
        j = int(np.searchsorted(offsets, start + PART, "right")) - 1
        if j > i:  # whole texts, after the rest of one that began earlier
            yield i, raw[start:offsets[j]], np.concatenate([[0], offsets[i + 1:j + 1] - start])
            i, start = j, int(offsets[j])
        elif offsets[i + 1] - start > PART:
            yield i, raw[start:start + PART], np.array([0, PART])
            start += PART
        else:
            yield i, raw[start:offsets[i + 1]], np.array([0, offsets[i + 1] - start])
            i, start = i + 1, int(offsets[i + 1])


class AttentionModel:
    """Encoder, gated attention and scorer with their training step."""

    def __init__(self, hidden: int = 32, gates: int = 16, seed: int = 11):
        rng = np.random.default_rng(seed)
        shapes = {"w": (FEATURES, hidden), "v": (hidden, gates), "u": (hidden, gates), "a": (gates,), "c": (hidden,)}
        self.p = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shapes.items()}
        self.p |= {"b": np.zeros(hidden), "d": np.zeros(1)}

    def _forward(self, x: np.ndarray, owner: np.ndarray, bags: int):
        p = self.p
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        # the logits are bounded by the weights, so their exponentials can be summed in parts
        e = np.exp((t * g) @ p["a"])
        total = np.bincount(owner, weights=e, minlength=bags)
        z = np.zeros((bags, h.shape[1]))
        np.add.at(z, owner, e[:, None] * h)
        return h, t, g, e, total, z

    def accumulate(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each text of a batch, passages summed part by part."""
        n = len(offsets) - 1
        total, z = np.zeros(n), np.zeros((n, len(self.p["c"])))
        for first, some, ends in parts(raw, offsets):
            owner, x = encode_passages(some, ends)
            _, _, _, _, s, zs = self._forward(x, owner, len(ends) - 1)
            total[first:first + len(s)] += s
            z[first:first + len(s)] += zs
        return self.score(z / np.maximum(total, 1e-300)[:, None])

    def score(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(z @ self.p["c"] + self.p["d"][0])))

    def gradients(self, x: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy over the bags."""
        p, bags = self.p, len(labels)
        h, t, g, e, total, z = self._forward(x, owner, bags)
        z = z / total[:, None]
        alpha = e / total[owner]
        dy = (self.score(z) - labels) / bags
        dz = dy[:, None] * p["c"]
        dh = alpha[:, None] * dz[owner]
        dlogit = alpha * ((dz[owner] * (h - z[owner])).sum(axis=1))
        dt, dg = dlogit[:, None] * p["a"] * g * (1 - t * t), dlogit[:, None] * p["a"] * t * g * (1 - g)
        dh += dt @ p["v"].T + dg @ p["u"].T
        dpre = dh * (1 - h * h)
        return {"w": x.T @ dpre, "b": dpre.sum(axis=0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ dlogit,
                "c": z.T @ dy, "d": np.array([dy.sum()])}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = 30, size: int = 64, rate: float = 0.01, seed: int = 5):
        """Adam over shuffled bags, with a little weight decay."""
        rng = np.random.default_rng(seed)
        m, s, step = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2)), None, 0
        m, s = m
        for epoch in range(epochs):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), size):
                own = order[i:i + size]
                x = np.concatenate([bags[j] for j in own])
                owner = np.repeat(np.arange(len(own)), [len(bags[j]) for j in own])
                step += 1
                for k, grad in self.gradients(x, owner, labels[own]).items():
                    grad = grad + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    s[k] = 0.999 * s[k] + 0.001 * grad * grad
                    self.p[k] = self.p[k] - rate * (1 - epoch / epochs) * (
                        m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def learn_quality(docs: DataFrame, labels: DataFrame, most: int = 6000, passages: int = 32,
                  id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> AttentionModel:
    """Fit on at most `most` labelled documents, those with the smallest hash of the id.

    Of a longer document at most `passages` evenly spaced passages teach; both bounds are what the
    driver holds. Labels other than 0 and 1 are left out, of several labels of an id the
    smallest counts. Without labels the model gives every text the score 0.5.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("y")).filter(F.col("y").isin(0, 1))
    known = known.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("y").alias("y"))
    # more ids than documents to fit on, as some labels may have no document here
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    sample = spark.createDataFrame(chosen.collect(), "doc_id long, y int")
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(sample), "doc_id")

    def encode(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            found = [[] for _ in range(len(offsets) - 1)]
            for first, some, ends in parts(raw, offsets):
                owner, x = encode_passages(some, ends)
                for i in range(len(ends) - 1):
                    found[first + i].append(x[owner == i].astype(np.float32))
            bags = [np.concatenate(f) for f in found]
            bags = [b[np.unique(np.linspace(0, len(b) - 1, passages).astype(int))] for b in bags]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([b.tobytes() for b in bags], pa.binary())], names=["doc_id", "y", "bag"])

    rows = texts.select("doc_id", "text", "y").mapInArrow(encode, "doc_id long, y int, bag binary").toPandas()
    model = AttentionModel()
    if not len(rows):
        model.p["c"][:] = 0
        return model
    rows = rows.sort_values(["doc_id", "bag"])  # the same order whatever the partitions
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES).astype(np.float64) for b in rows.bag]
    return model.fit(bags, rows.y.to_numpy(np.float64))


def score_quality(docs: DataFrame, model: AttentionModel, keep: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted (1 if score >= `keep`) for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            scores = shared.value.accumulate(raw, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= keep).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, keep: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that score at least `keep`, with all their columns; labels are held out as for scoring."""
    taught = labels.filter(F.coalesce(crc_mod(F.col(id_col), 4) != 2, F.lit(False)))
    shared = docs.sparkSession.sparkContext.broadcast(learn_quality(docs, taught, id_col=id_col, text_col=text_col))
    return keep_rows(docs, text_col, lambda texts: shared.value.accumulate(*text_bytes(texts)) >= keep)


def classify_quality(docs: DataFrame, labels: DataFrame, keep: float = 0.7, train: Column | None = None, most: int = 6000,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from labelled rows and score every whole text: doc_id, held_out, score, predicted.

    Labels of ids with crc32(id) mod 4 = 2 are held out, or those that `train` (a condition on
    `labels`) does not pick. A null text is empty; empty texts get the score of an empty passage. A
    null id is held out and teaches nothing. Repeated rows are scored once each; an empty table
    gives no rows; other columns are not read. Eager: the model is fitted at once.
    """
    taught = labels.filter(F.coalesce(crc_mod(F.col(id_col), 4) != 2, F.lit(False)) if train is None else train)
    found = score_quality(docs, learn_quality(docs, taught, most, id_col=id_col, text_col=text_col), keep, id_col, text_col)
    return found.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(True)).alias("held_out"), "score", "predicted")
