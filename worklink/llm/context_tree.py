"""Language-model scoring by context-tree weighting.

The next symbol of a text is a walk through a binary tree of six decisions. Each decision has a context
tree over the preceding symbols, whose nodes hold the counts of both outcomes. A node's
Krichevsky-Trofimov estimate is weighed against the product of its children's, so the
prediction mixes all depths with weights that the whole corpus gives.

Counts come from all training texts, and every context that occurs in them is kept. Contexts that
hold a share of the corpus, at most 1/share per depth, form one tree that is broadcast. The rarer
ones hang below it in small forests, one per bucket of the tree's nodes; positions that lead into them are
sent to the bucket and scored there.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from worklink.llm.common import crc_mod, id_and_text, stored

DEPTH = 5
BITS = 6
SYMBOLS = 1 << BITS
NODES = SYMBOLS - 1  # inner nodes of the decision tree
END, ESCAPE = 0, SYMBOLS - 1  # symbols: end (and what precedes a text), a byte outside the alphabet
END_BYTE = 0x41  # a capital letter never occurs once a text is in lower case
PART = 1 << 19  # bytes worked on at a time


# ---------------------------------------------------------------- texts as symbol streams


def alphabet(counts: np.ndarray) -> np.ndarray:
    """Symbol of every byte: the most frequent bytes have their own, the rest is escaped."""
    order = np.lexsort((np.arange(256), -counts))
    table = np.full(256, ESCAPE, np.uint8)
    frequent = [b for b in order if b != END_BYTE and counts[b]][:SYMBOLS - 2]
    table[frequent] = np.arange(1, len(frequent) + 1)
    table[END_BYTE] = END
    return table


def streams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of some texts in lower case, positions to predict and the text each belongs to.

    Every text is preceded by DEPTH ends and followed by one. Long texts come in
    several parts, each with the DEPTH bytes before it.
    """
    pad = bytes([END_BYTE]) * DEPTH
    parts: list[bytes] = []
    rows: list[int] = []
    size = 0
    for row, text in enumerate(texts):
        whole = pad + text + pad[:1]
        for start in range(DEPTH, len(whole), PART):
            parts.append(whole[start - DEPTH:start + PART])
            rows.append(row)
            size += len(parts[-1])
            if size >= PART:
                yield _positions(parts, rows)
                parts, rows, size = [], [], 0
    if parts:
        yield _positions(parts, rows)


def _positions(parts, rows):
    lengths = np.array([len(p) for p in parts])
    owner = np.repeat(np.array(rows), lengths)
    inner = np.ones(len(owner), bool)
    starts = np.cumsum(lengths) - lengths
    for i in range(DEPTH):
        inner[starts + i] = False
    at = np.flatnonzero(inner)
    return np.frombuffer(b"".join(parts), np.uint8), at, owner[at]


def gram_codes(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A symbol in the lowest bits, the one before it in the next, and so on."""
    code = symbols[at].astype(np.int64)
    for back in range(1, DEPTH + 1):
        code |= symbols[at - back].astype(np.int64) << (BITS * back)
    return code


def lowered(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()  # of bytes: A to Z only


def word_hashes(words: Iterable[bytes], n: int) -> np.ndarray:
    """Signed hashes of n words."""
    return (np.fromiter(map(xxh3_64_intdigest, words), np.uint64, n) ^ np.uint64(1 << 63)).view(np.int64)


# ---------------------------------------------------------------- the corpus counted


def byte_counts(docs: DataFrame) -> np.ndarray:
    """How often each byte occurs in all texts."""

    def run(batches):
        total = np.zeros(256, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(lowered(text), np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int64()), pa.array(total)], names=["byte", "n"])

    rows = docs.select("text").mapInArrow(run, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(256, np.int64)
    for r in rows:
        counts[r.byte] = r.n
    return counts


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(n, first)


def distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[first], np.diff(np.r_[first, len(codes)])


def count_corpus(docs: DataFrame, table: np.ndarray, most: int = 500_000) -> DataFrame:
    """(gram, key, n): symbol grams and hashed words of all texts; tasks add up what they hold.

    A task that holds `most` different grams or words sends its sums and starts anew.
    """

    def emit(gram, key, n):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), gram)), pa.array(key, pa.int64()), pa.array(n, pa.int64())], names=["gram", "key", "n"])

    def flush(words):
        return emit(False, word_hashes(words, len(words)), np.array(list(words.values()), np.int64))

    def run(batches):
        keys, counts, held = [], [], 0
        words: Counter[bytes] = Counter()
        for batch in batches:
            texts = [lowered(t) for t in batch.column(0).to_pylist()]
            for raw, at, _ in streams(texts):
                key, n = distinct(gram_codes(table[raw], at))
                keys, counts, held = keys + [key], counts + [n], held + len(key)
                if held > most:
                    key, n = merged(keys, counts)
                    if len(key) > most // 2:
                        yield emit(True, key, n)
                        keys, counts, held = [], [], 0
                    else:
                        keys, counts, held = [key], [n], len(key)
            for text in texts:
                words.update(text.split())
                if len(words) > most:
                    yield flush(words)
                    words = Counter()
        if keys:
            yield emit(True, *merged(keys, counts))
        if words:
            yield flush(words)

    partial = docs.select("text").mapInArrow(run, "gram boolean, key long, n long")
    return partial.groupBy("gram", "key").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- the weighted tree


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function, by Stirling's series above 8."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        small = y < 8
        shift = np.where(small, shift + np.log(np.where(small, y, 1.0)), shift)
        y = np.where(small, y + 1, y)
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def block_probability(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


def decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at each inner node of the decision tree, from counts per symbol."""
    zeros, ones = np.empty((len(counts), NODES)), np.empty((len(counts), NODES))
    level = counts.astype(np.float64)
    for depth in reversed(range(BITS)):
        first = (1 << depth) - 1
        zeros[:, first:2 * first + 1], ones[:, first:2 * first + 1] = level[:, 0::2], level[:, 1::2]
        level = level[:, 0::2] + level[:, 1::2]
    return zeros, ones


def blocks(n: int, size: int = 1024) -> Iterator[slice]:
    """The driver works on so many contexts at a time."""
    for i in range(0, n, size):
        yield slice(i, i + size)


def estimates(counts: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability at each inner node of each context's decision tree."""
    out = np.empty((len(counts), NODES))
    for at in blocks(len(counts)):
        out[at] = block_probability(*decisions(counts[at]))
    return out


def symbol_logs(ones: np.ndarray) -> np.ndarray:
    """Log10 probability of each symbol from the chance of a one at each node."""
    total = np.zeros((len(ones), 1))
    for depth in range(BITS):
        first = (1 << depth) - 1
        p = np.clip(ones[:, first:2 * first + 1], 1e-12, 1 - 1e-12)
        total = np.stack([total + np.log10(1 - p), total + np.log10(p)], axis=2).reshape(len(ones), 2 * total.shape[1])
    return total


def links(levels: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[int], list[np.ndarray]]:
    """Number of each depth's first node, and per depth the child (or -1) by node and symbol."""
    first, children = [0], []
    for d, (codes, _) in enumerate(levels[:-1]):
        first.append(first[-1] + len(codes))
        child = np.full((len(codes), SYMBOLS), -1, np.int32)
        deeper = levels[d + 1][0]
        child[np.searchsorted(codes, deeper & ((1 << (BITS * d)) - 1)), deeper >> (BITS * d)] = np.arange(len(deeper))
        children.append(child.ravel())
    return first, children


def deepest(first: list[int], children: list[np.ndarray], grams: np.ndarray) -> np.ndarray:
    """The deepest node of the tree on the way to each gram's context."""
    out, node, alive = np.zeros(len(grams), np.int32), np.zeros(len(grams), np.int32), np.arange(len(grams))
    for d, child in enumerate(children):
        found = child[node * SYMBOLS + (grams[alive] >> (BITS * (d + 1)) & (SYMBOLS - 1))]
        deeper = found >= 0
        alive, node = alive[deeper], found[deeper]
        out[alive] = first[d + 1] + node
    return out


class Forest:
    """The contexts below some nodes of the broadcast tree, from their grams.

    A rare context has met few symbols, so only the decisions that it met are kept. Its depth's pairs of context
    and symbol are sorted; those whose symbols begin with the same bits are neighbours and share a decision. A
    decision that a context has not met has even odds everywhere below, which gives the prediction
    of the nearest shorter context that met it.
    """

    def __init__(self, first: list[int], nodes: np.ndarray, keys: np.ndarray, n: np.ndarray):
        self.first = first
        self.nodes, slot = np.unique(nodes, return_inverse=True)
        depth = np.searchsorted(first, nodes, "right") - 1
        #: per depth the pairs, their counts, whether they hang at a node, and the place of that node or of the shorter pair
        self.pairs: list[np.ndarray] = []
        self.counts, self.root, self.up = [], [], []
        for d in range(1, DEPTH + 1):
            own = np.flatnonzero(depth < d)
            codes, at, inverse = np.unique(pair(keys[own], d), return_index=True, return_inverse=True)
            root = depth[own[at]] == d - 1
            above = self.pairs[-1] if self.pairs else np.zeros(0, np.int64)
            self.up.append(np.where(root, slot[own[at]], np.searchsorted(above, pair(codes, d - 1))))
            self.pairs.append(codes)
            self.counts.append(np.bincount(inverse, n[own], len(codes)).astype(np.int64))
            self.root.append(root)
        top = max((int((zeros + ones).max()) for _, _, zeros, ones in self.met(0) if len(zeros)), default=0) + 1
        #: logarithms of the gamma function at whole and a half, and from one on
        self.half, self.whole = log_gamma(np.arange(top) + 0.5), log_gamma(np.arange(top) + 1.0)

    def met(self, bit: int) -> list[tuple]:
        """Per depth: group of each pair, first pair of each group, zeros and ones, for the decisions about one bit."""
        out = []
        for codes, n in zip(self.pairs, self.counts):
            begin = codes >> (BITS - bit)
            new = np.r_[True, begin[1:] != begin[:-1]][:len(codes)]
            group, starts = np.cumsum(new) - 1, np.flatnonzero(new)
            one = codes >> (BITS - bit - 1) & 1
            both = np.bincount(group, n, len(starts)).astype(np.int64)
            ones = np.bincount(group, n * one, len(starts)).astype(np.int64)
            out.append((group, starts, both - ones, ones))
        return out

    def weigh(self, bit: int, met: list[tuple]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Weighted log probabilities below each node [nodes, decisions about the bit], log odds of stopping per depth."""
        sums = np.zeros(len(self.nodes) << bit)
        stop: list[np.ndarray] = [np.zeros(0)] * DEPTH
        children = None
        for d in reversed(range(DEPTH)):
            group, starts, zeros, ones = met[d]
            weighted = self.half[zeros] + self.half[ones] - np.log(np.pi) - self.whole[zeros + ones]
            if children is not None:
                stop[d] = weighted - children
                weighted = np.logaddexp(weighted, children) - np.log(2)
            up, root = self.up[d][starts], self.root[d][starts]
            at = (up[root] << bit) + (self.pairs[d][starts[root]] >> (BITS - bit) & ((1 << bit) - 1))
            sums += np.bincount(at, weighted[root], len(sums))
            if d:
                children = np.bincount(met[d - 1][0][up[~root]], weighted[~root], len(met[d - 1][1]))
        return sums.reshape(len(self.nodes), 1 << bit), stop

    def sums(self) -> np.ndarray:
        """Weighted log probabilities of what hangs at each node, added up [nodes, decisions]."""
        return np.concatenate([self.weigh(bit, self.met(bit))[0] for bit in range(BITS)], axis=1)

    def predict(self, tree: ContextTree) -> None:
        """Chance of a one at each decision of every pair's symbol."""
        self.tree = tree
        self.ones = [np.empty((len(codes), BITS), np.float32) for codes in self.pairs]
        for bit in range(BITS):
            met = self.met(bit)
            _, stop = self.weigh(bit, met)
            below = None
            for d in range(DEPTH):
                group, starts, zeros, ones = met[d]
                own = (ones + 0.5) / (zeros + ones + 1)
                up, root = self.up[d][starts], self.root[d][starts]
                gathered, share = np.empty_like(own), np.empty_like(own)
                gathered[root], share[root] = tree.passed[:, self.nodes[up[root]], decision(self.pairs[d][starts[root]], bit)]
                if below is not None:
                    shorter = met[d - 1][0][up[~root]]
                    gathered[~root], share[~root] = below[0][shorter], below[1][shorter]
                if d < DEPTH - 1:
                    weight = 1 / (1 + np.exp(np.clip(-stop[d], -700, 700)))
                    below = gathered + share * weight * own, share * (1 - weight)
                    last = below[0] + below[1] * 0.5
                else:
                    last = gathered + share * own
                self.ones[d][:, bit] = last[group]
        self.logs = chance(self.ones[-1], self.pairs[-1])
        self.counts = self.up = self.root = []

    def scores(self, keys: np.ndarray) -> np.ndarray:
        """Log10 probability of each gram's symbol after its context."""
        full = self.pairs[-1]
        place = np.minimum(np.searchsorted(full, keys), max(len(full) - 1, 0))
        known = full[place] == keys if len(full) else np.zeros(len(keys), bool)
        out = np.empty(len(keys))
        out[known] = self.logs[place[known]]
        keys = keys[~known]
        nodes = deepest(self.first, self.tree.child, keys)
        ones = np.stack([self.tree.passed[:, nodes, decision(keys, bit)].T @ (1, 0.5) for bit in range(BITS)], axis=1)
        depth = np.searchsorted(self.first, nodes, "right") - 1
        alive = np.ones(len(keys), bool)  # a context that never occurred has none below
        for d, codes in enumerate(self.pairs):
            at = np.flatnonzero(alive & (depth <= d))
            for bit in range(BITS):
                begin = pair(keys[at], d + 1) >> (BITS - bit)
                place = np.searchsorted(codes, begin << (BITS - bit))
                found = place < len(codes)
                found[found] = codes[place[found]] >> (BITS - bit) == begin[found]
                if bit == 0:
                    alive[at[~found]] = False
                at = at[found]
                ones[at, bit] = self.ones[d][place[found], bit]
        out[~known] = chance(ones, keys)
        return out


def pair(keys: np.ndarray, depth: int) -> np.ndarray:
    """A gram's symbol with so many of the symbols before it."""
    return keys & ((1 << (BITS * (depth + 1))) - 1)


def decision(keys: np.ndarray, bit: int) -> np.ndarray:
    """The node of the decision tree that a gram's symbol reaches after so many bits."""
    return (1 << bit) - 1 + (keys >> (BITS - bit) & ((1 << bit) - 1))


def chance(ones: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Log10 probability of each gram's symbol from the chance of a one at each of its decisions."""
    taken = (keys[:, None] >> np.arange(BITS - 1, -1, -1) & 1).astype(bool)
    p = np.clip(ones.astype(np.float64), 1e-12, 1 - 1e-12)
    return np.log10(np.where(taken, p, 1 - p)).sum(axis=1)


class ContextTree:
    """Log probabilities of the next symbol for every context of a bounded tree."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], table: np.ndarray, escaped: np.ndarray,
                 sums: np.ndarray | None = None):
        """`levels`: per depth the sorted codes of its contexts and their counts [contexts, symbols].

        `escaped`: how often each byte outside the alphabet occurs. Every context's
        suffixes are contexts too. `sums`: the weighted log probabilities of each node's children outside the
        tree, added up [nodes, decisions]; without them what no child has counts as one remaining child.
        """
        self.table = table
        tail = escaped.astype(np.float64) + 0.5
        self.escape = (np.log10(tail) - np.log10(tail.sum())).astype(np.float64)
        depths = len(levels) - 1
        parent = [np.zeros(0, np.int64)] * (depths + 1)
        for d in range(1, depths + 1):
            # the oldest symbol is the highest: dropping it gives the parent
            parent[d] = np.searchsorted(levels[d - 1][0], levels[d][0] & ((1 << (BITS * (d - 1))) - 1))
        rest = [None] * (depths + 1)  # counts that no kept child has
        stop = [None] * (depths + 1)  # log of the odds of stopping at a node
        below = None
        for d in reversed(range(depths + 1)):
            weighted = estimates(levels[d][1])
            if d < depths:
                children = np.zeros_like(weighted)
                np.add.at(children, parent[d + 1], below)
                if sums is None:
                    other = levels[d][1].copy()
                    np.subtract.at(other, parent[d + 1], levels[d + 1][1])
                    rest[d] = np.maximum(other, 0)
                    children += estimates(rest[d])
                else:  # a child that never occurred has no counts
                    before = sum(len(codes) for codes, _ in levels[:d])
                    children += sums[before:before + len(children)]
                stop[d] = weighted - children
                weighted = np.logaddexp(weighted, children) - np.log(2)
            below = weighted
        rows, passed, below, weighted, children = [], [], None, None, None
        self.first, self.child = links(levels)
        for d in range(depths + 1):
            size = len(levels[d][0])
            rows.append(np.empty((size, SYMBOLS), np.float32))
            handed = np.empty((2, size, NODES)) if d < depths else None
            for at in blocks(size):
                zeros, ones = decisions(levels[d][1][at])
                own = (ones + 0.5) / (zeros + ones + 1)
                gathered, share = (below[i][parent[d][at]] for i in (0, 1)) if d else (np.zeros_like(own), np.ones_like(own))
                if d < depths:
                    weight = 1 / (1 + np.exp(np.clip(-stop[d][at], -700, 700)))
                    other = 0.5  # without counts
                    if rest[d] is not None:
                        zeros, ones = decisions(rest[d][at])
                        other = (ones + 0.5) / (zeros + ones + 1)
                    last = gathered + share * (weight * own + (1 - weight) * other)
                    handed[0, at], handed[1, at] = gathered + share * weight * own, share * (1 - weight)
                else:
                    last = gathered + share * own
                rows[d][at] = symbol_logs(last)
            below = handed
            if d < depths and sums is not None:
                passed.append(below.astype(np.float32))
        # what a node hands to children outside the tree: the mixture so far, and what is left to share
        self.passed = np.concatenate(passed, axis=1) if passed else None
        self.logs = np.concatenate(rows).ravel()

    def scores(self, texts: list[bytes], rare: list | None = None) -> np.ndarray:
        """Log10 probability of each text with its end.

        With `rare`, positions that may have a deeper context outside the tree are left out and
        appended to it: their text, the tree's node and the gram.
        """
        out = np.zeros(len(texts))
        for raw, at, owner in streams(texts):
            symbols = self.table[raw].astype(np.int32)
            node = np.zeros(len(at), np.int32)
            row = np.zeros(len(at), np.int32)
            alive = np.arange(len(at))
            for d, child in enumerate(self.child):
                found = child[node * SYMBOLS + symbols[at[alive] - d - 1]]
                deeper = found >= 0
                alive, node = alive[deeper], found[deeper]
                row[alive] = self.first[d + 1] + node
            logs = self.logs[row.astype(np.int64) * SYMBOLS + symbols[at]].astype(np.float64)
            strange = symbols[at] == ESCAPE
            if rare is not None:
                leaving = np.flatnonzero(row < self.first[-1])
                rare.append((owner[leaving], row[leaving], gram_codes(self.table[raw], at[leaving])))
                logs[leaving] = 0
            logs[strange] += self.escape[raw[at[strange]]]
            out += np.bincount(owner, weights=logs, minlength=len(texts))
        return out


def common_contexts(grams: DataFrame, total: int, share: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """The levels of all contexts that hold at least `share` of the corpus, from its (key, n) grams.

    At most 1/share contexts per depth with SYMBOLS counts each reach the driver.
    """
    levels = []
    kept = None
    for depth in range(DEPTH + 1):
        mask = (1 << (BITS * (depth + 1))) - 1
        level = grams.groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("key")).agg(F.sum("n").alias("n"))
        level = level.select(F.shiftright("key", BITS).alias("context"), F.col("key").bitwiseAND(F.lit(SYMBOLS - 1)).alias("symbol"), "n")
        sizes = level.groupBy("context").agg(F.sum("n").alias("size")).filter(F.col("size") >= F.lit(max(1.0, share * total)))
        rows = level.join(sizes.select("context"), "context").toPandas() if depth else level.toPandas()
        codes = np.unique(rows.context.to_numpy(np.int64)) if len(rows) else np.zeros(int(depth == 0), np.int64)
        if kept is not None:  # a rounding difference must not leave a context without its parent
            codes = codes[np.isin(codes & ((1 << (BITS * (depth - 1))) - 1), kept)]
        matrix = np.zeros((len(codes), SYMBOLS), np.int64)
        if len(rows):
            at = np.searchsorted(codes, rows.context.to_numpy(np.int64))
            own = (at < len(codes)) & (codes[np.minimum(at, max(len(codes) - 1, 0))] == rows.context) if len(codes) else np.zeros(len(rows), bool)
            matrix[at[own], rows.symbol.to_numpy(np.int64)[own]] = rows.n.to_numpy(np.int64)[own]
        levels.append((codes, matrix))
        kept = codes
    return levels


PIECE = "bucket int, kind int, asker int, data binary"
NAMES = [f.split()[0] for f in PIECE.split(", ")]
TAUGHT, ASKED, TEXT = range(3)  # kinds of pieces, in the order a bucket is read


def pieces(bucket: list, kind: int, data: list, asker: int | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array([kind] * len(bucket), pa.int32()), pa.array([asker] * len(bucket), pa.int32()),
         pa.array(data, pa.binary())], names=NAMES)


def scored(row: np.ndarray, score: np.ndarray) -> bytes:
    """Keys of rows and a number for each."""
    return row.astype("<i8").tobytes() + score.astype("<f8").tobytes()


def unscored(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    half = len(data) // 2
    return np.frombuffer(data[:half], "<i8"), np.frombuffer(data[half:], "<f8")


def packed(keys: np.ndarray, extra: np.ndarray) -> bytes:
    """Sorted grams as differences, and one number each, by planes of bytes: they compress well."""
    steps = np.diff(keys, prepend=0).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    return np.concatenate([steps, extra.astype("<u4").view(np.uint8).reshape(-1, 4)], axis=1).T.tobytes()


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(9, -1).T.astype(np.int64)
    weights = 256 ** np.arange(5, dtype=np.int64)
    return np.cumsum(planes[:, :5] @ weights), planes[:, 5:] @ weights[:4]


def with_rows(keys: np.ndarray, owner: np.ndarray, rows: np.ndarray) -> bytes:
    """Packed grams, after the keys of the rows that ask for them."""
    named, owner = np.unique(owner, return_inverse=True)
    return np.int64(len(named)).tobytes() + rows[named].astype("<i8").tobytes() + packed(keys, owner)


def without_rows(data: bytes) -> tuple[bytes, np.ndarray]:
    end = 8 + 8 * int(np.frombuffer(data[:8], "<i8")[0])
    return data[end:], np.frombuffer(data[8:end], "<i8")


def by_bucket(bucket: np.ndarray, keys: np.ndarray, extra: np.ndarray, rows: np.ndarray | None = None) -> tuple[list, list]:
    """Buckets and their packed grams, each with its number or, where `rows` is given, the row at that place."""
    order = np.argsort(bucket.astype(np.int64) << 36 | keys)
    bucket, keys, extra = bucket[order], keys[order], extra[order]
    ends = np.r_[np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)] if len(bucket) else []
    spans = list(zip([0, *ends[:-1]], ends))
    return [int(bucket[a]) for a, _ in spans], [
        packed(keys[a:b], extra[a:b]) if rows is None else with_rows(keys[a:b], extra[a:b], rows) for a, b in spans]


def rare_grams(grams: DataFrame, walk, buckets: int, most: int = 500_000) -> DataFrame:
    """Pieces of the grams whose context is not in the tree, by bucket of the node they hang below.

    About `most` grams are dealt at a time, so that pieces are long.
    """

    def dealt(batches):
        keys, n = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in batches]) for i in range(2))
        first, children = walk.value
        nodes = deepest(first, children, keys)
        own = np.flatnonzero(nodes < first[-1])
        while len(own):  # a count beyond 32 bits comes in several parts
            part = np.minimum(n[own], (1 << 32) - 1)
            at, data = by_bucket(nodes[own] % buckets, keys[own], part)
            yield pieces(at, TAUGHT, data)
            n = n.copy()
            n[own] -= part
            own = own[n[own] > 0]

    def run(batches):
        held: list = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= most:
                yield from dealt(held)
                held = []
        if held:
            yield from dealt(held)

    return grams.mapInArrow(run, PIECE)


def forests(batches, first: list[int], children: list[np.ndarray]) -> Iterator[tuple[Forest, int, int | None, bytes]]:
    """(forest, kind, asker, data) of the rows of some buckets, sorted by bucket and kind.

    A forest comes once with kind TAUGHT; kind TEXT has none.
    """
    now, held, forest = None, [], None

    def grown():
        parts = [unpacked(data) for data in held]
        held.clear()
        keys, n = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(2))
        return Forest(first, deepest(first, children, keys), keys, n)

    for batch in batches:
        data_of = batch.column(3)  # long pieces: one at a time
        for i, (bucket, kind, asker) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:3]))):
            data = data_of[i].as_py()
            if bucket != now:
                if held:
                    yield grown(), TAUGHT, None, b""
                now, forest = bucket, None
            if kind == TAUGHT:
                held.append(data)
            elif kind == ASKED:
                if forest is None:
                    forest = grown()
                    yield forest, TAUGHT, None, b""
                yield forest, kind, asker, data
            else:
                yield None, kind, asker, data
    if held:
        yield grown(), TAUGHT, None, b""


def learn_tree(grams: DataFrame, table: np.ndarray, counts: np.ndarray, total: int, share: float, held: float,
               buckets: int, tasks: int) -> tuple[ContextTree, DataFrame | None]:
    """The tree to broadcast, and the pieces of rarer grams; None where contexts below `share` fall together.

    Sums of at most 1/held nodes per depth reach the driver.
    """
    levels = common_contexts(grams, total, share or held)
    escaped = np.where(table == ESCAPE, counts, 0)
    if share:
        return ContextTree(levels, table, escaped), None
    walk = grams.sparkSession.sparkContext.broadcast(links(levels))
    rare = rare_grams(grams, walk, buckets)

    def run(batches):
        for forest, *_ in forests(batches, *walk.value):
            yield pa.RecordBatch.from_arrays(
                [pa.array(forest.nodes, pa.int64()), pa.array([x.tobytes() for x in forest.sums()], pa.binary())], names=["node", "sums"])

    dealt = rare.repartition(tasks, "bucket").sortWithinPartitions("bucket", "kind")
    sums = np.zeros((sum(len(codes) for codes, _ in levels), NODES))
    found = dealt.mapInArrow(run, "node long, sums binary").toPandas()
    for node, data in zip(found.node, found.sums):
        sums[node] = np.frombuffer(data)
    del found
    return ContextTree(levels, table, escaped, sums), rare


class Answers:
    """Scores by asker and row, added up; handed over as one piece per asker."""

    def __init__(self, most: int):
        self.most, self.size, self.held = most, 0, {}

    def add(self, asker: int, row: np.ndarray, score: np.ndarray) -> list[tuple[int, bytes]]:
        """Take some in; what is held goes once it stays beyond half of `most` rows."""
        rows, scores = self.held.setdefault(asker, ([], []))
        rows.append(row)
        scores.append(score)
        self.size += len(row)
        if self.size < self.most:
            return []
        self.held = {k: tuple([x] for x in merged(*v)) for k, v in self.held.items()}
        self.size = sum(len(v[0][0]) for v in self.held.values())
        return self.all() if self.size >= self.most // 2 else []

    def all(self) -> list[tuple[int, bytes]]:
        out = [(k, scored(*merged(*v))) for k, v in self.held.items()]
        self.size, self.held = 0, {}
        return out


def tree_scores(rows: DataFrame, tree, rare: DataFrame, buckets: int, tasks: int, most: int = 1_000_000) -> DataFrame:
    """(row, tree_score) of each different row key of (doc_id, text, row) under the tree and its forests.

    Whoever asks for the rows of a partition gets the sums of each task's buckets as one piece.
    """

    def run(batches):
        asked, size, asker = [], 0, TaskContext.get().partitionId()

        def flush():
            owner, nodes, keys = (np.concatenate([a[i] for a in asked]) for i in range(3))
            asked_by, owner = np.unique(owner, return_inverse=True)
            at, data = by_bucket(nodes % buckets, keys, owner, asked_by)
            return pieces(at, ASKED, data, asker)

        for batch in batches:
            texts = [lowered(t) for t in batch.column(1).to_pylist()]
            row = batch.column(2).to_numpy(zero_copy_only=False)
            found: list = []
            scores = tree.value.scores(texts, found)
            asked += [(row[owner], nodes, keys) for owner, nodes, keys in found]
            size += sum(len(f[0]) for f in found)
            yield pieces([asker % buckets], TEXT, [scored(row, scores)], asker)
            if size >= most:
                yield flush()
                asked, size = [], 0
        if size:
            yield flush()

    def answer(batches):
        def told(found, kind=ASKED):
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.int32()), pa.array([kind] * len(found), pa.int32()),
                 pa.array([data for _, data in found], pa.binary())], names=["asker", "kind", "data"])

        held = Answers(most)
        for forest, kind, asker, data in forests(batches, tree.value.first, tree.value.child):
            if kind == TEXT:
                yield told([(asker, data)], TEXT)
                continue
            if kind == TAUGHT:
                forest.predict(tree.value)
                continue
            data, asked_by = without_rows(data)
            keys, owner = unpacked(data)
            if full := held.add(asker, asked_by, np.bincount(owner, forest.scores(keys), len(asked_by))):
                yield told(full)
        if held.size:
            yield told(held.all())

    def add_up(batches):
        now, held = None, []  # keys, scores and copies of an asker's rows

        def sums():
            keys, scores, copies = (np.concatenate([h[i] for h in held]) for i in range(3))
            row, at = np.unique(keys, return_inverse=True)
            return row, np.bincount(at, scores, len(row)), np.bincount(at, copies, len(row)).astype(np.int64)

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(c) for c in sums()], names=["row", "score", "copies"])

        size = 0
        for batch in batches:
            for asker, kind, data in zip(*(c.to_pylist() for c in batch.columns)):
                if asker != now and held:
                    yield batch_of()
                    held, size = [], 0
                row, score = unscored(data)
                now, size = asker, size + len(row)
                held.append((row, score, np.full(len(row), int(kind == TEXT))))
                if size >= most + 2 * len(held[0][0]):
                    held = [sums()]
                    size = len(held[0][0])
        if held:
            yield batch_of()

    ordered = rows.mapInArrow(run, PIECE).unionByName(rare).repartition(tasks, "bucket")
    answers = ordered.sortWithinPartitions("bucket", "kind").mapInArrow(answer, "asker int, kind int, data binary")
    summed = answers.repartition(tasks, "asker").sortWithinPartitions("asker").mapInArrow(add_up, "row long, score double, copies long")
    # repeated rows ask together: each has its share
    return summed.groupBy("row").agg((F.sum("score") / F.sum("copies")).alias("tree_score"))


# ---------------------------------------------------------------- scoring


class Scorer:
    """Tree scores of texts, and the base model's for frequent words."""

    def __init__(self, tree: ContextTree | None, words: np.ndarray, counts: np.ndarray, tokens: int, kinds: int, ends: int):
        """`words`: the sorted hashes of the frequent words, `counts` their counts."""
        self.tree, self.words, self.tokens, self.kinds = tree, words, tokens, kinds
        self.bases, self.end = self.base(counts), self.base(ends)

    def base(self, count):
        return np.log10((count + 0.1) / (self.tokens + 0.1 * (self.kinds + 1)))

    def rows(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """Per text its tokens, base score of frequent tokens and the end, tree score; then text, hash and times of other words."""
        found = [text.split() for text in texts]
        n = np.array([len(words) for words in found], np.int64)
        keys = word_hashes(chain.from_iterable(found), n.sum())
        owner = np.repeat(np.arange(len(texts)), n)
        at = np.minimum(np.searchsorted(self.words, keys), max(len(self.words) - 1, 0))
        known = self.words[at] == keys if len(self.words) else np.zeros(len(keys), bool)
        base = np.bincount(owner[known], self.bases[at[known]], len(texts)) + self.end
        owner, keys = owner[~known], keys[~known]
        order = np.lexsort((keys, owner))
        owner, keys = owner[order], keys[order]
        first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])][:len(keys)])
        score = self.tree.scores(texts) if self.tree else np.zeros(len(texts))
        return n + 1, base, score, owner[first], keys[first], np.diff(np.r_[first, len(keys)])


def model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train: Column | None = None,
                 share: float = 0.0, word_share: float = 2.0 ** -20, held: float = 2.0 ** -17, forest_grams: int = 250_000) -> DataFrame:
    """Score all whole texts under a context tree and a word model learned from the training rows.

    Training rows are those whose crc32(id) mod 10 is not 0, or `train`. Columns: doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte (code length of
    the text and its end). Texts are in lower case (A to Z). A null text is empty: one
    token, its end. A null id is held out. Repeated rows are scored once each. Where
    nothing can be learned all counts are 0. Every context is kept; with `share`, those with less of the
    corpus fall together in one child of their parent. Contexts with at least `held` of the corpus form the tree
    that is broadcast, rarer ones meet the texts in a shuffle, dealt to buckets of about
    `forest_grams` different grams. Words with at least `word_share` of all
    tokens (at most 1/word_share) and the tree are broadcast; other words meet
    their counts in a join, in which none is frequent. Words are told apart by a 64-bit hash.
    Eager: counting runs at once.
    """
    spark = docs.sparkSession
    held_out = F.coalesce(crc_mod(F.col(id_col), 10) == 0, F.lit(True))
    # keyed by content: a task that runs again may read its rows in another order
    rows = id_and_text(docs, id_col, text_col).withColumn("row", F.xxhash64("doc_id", "text"))
    taught = id_and_text(docs.filter(~held_out if train is None else train), id_col, text_col)
    ends = taught.count()
    seen = byte_counts(taught)
    table = alphabet(seen)
    stats = stored(count_corpus(taught, table), "corpus")
    grams, words = (stats.filter(c).select("key", "n") for c in (F.col("gram"), ~F.col("gram")))
    totals = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).first()
    different = grams.count()
    tokens, kinds = (totals.n or 0) + ends, totals.kinds + int(ends > 0)
    # a task holds one bucket at a time, however many it works through
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-different // (16 * forest_grams)))
    buckets = max(4 * tasks, -(-different // forest_grams))
    tree, rare_part = learn_tree(grams, table, seen, int(seen.sum()) + ends, share, held, buckets, tasks)
    frequent = words.filter(F.col("n") >= F.lit(word_share * tokens)).orderBy("key").toPandas()
    scorer = spark.sparkContext.broadcast(
        Scorer(tree if rare_part is None else None, frequent.key.to_numpy(np.int64), frequent.n.to_numpy(np.int64), tokens, kinds, ends))

    def run(batches):
        for batch in batches:
            texts = [lowered(t) for t in batch.column(1).to_pylist()]
            row = batch.column(2).to_numpy(zero_copy_only=False)
            n, base, score, owner, word, times = scorer.value.rows(texts)
            info = pa.StructArray.from_arrays(
                [batch.column(0).cast(pa.int64()), *map(pa.array, (n, base, score)), pa.array(map(len, texts), pa.int64())], fields=list(INFO))
            own = pa.array(np.arange(len(texts)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[row, row[owner]]), pa.array(np.r_[row, word]), pa.array(np.r_[np.zeros(len(row), np.int64), times]),
                 info.take(pa.concat_arrays([own, pa.nulls(len(owner), own.type)]))], names=["row", "word", "times", "info"])

    parts = rows.mapInArrow(
        run, "row long, word long, times long, info struct<doc_id long, n_tokens long, base double, score double, bytes long>")
    # a document's own row carries no word (times 0) and a key that spreads it
    joined = parts.join(words.withColumnRenamed("key", "word"), "word", "left")
    count = F.coalesce("n", F.lit(0))
    each = F.log10((count + F.lit(0.1)) / F.lit(tokens + 0.1 * (kinds + 1)))
    summed = joined.groupBy("row").agg(
        F.max("info").alias("i"), F.count("info").alias("copies"),
        F.sum(F.when(F.col("times") > 0, F.col("times") * each).otherwise(0.0)).alias("rare_base"),
        F.sum(F.when(count == 0, F.col("times")).otherwise(0)).alias("unknown"))
    score = F.col("i.score")
    if rare_part is not None:
        summed = summed.join(tree_scores(rows, spark.sparkContext.broadcast(tree), rare_part, buckets, tasks), "row", "left")
        score = F.col("tree_score")
    # one row for each copy, in blocks so that no array grows with the copies
    block = summed.withColumn("block", F.explode(F.sequence(F.lit(0), ((F.col("copies") - 1) / COPIES).cast("long"))))
    apart = block.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.lit(COPIES), F.col("copies") - F.col("block") * COPIES))))
    return apart.select(
        F.col("i.doc_id").alias("doc_id"),
        F.coalesce(crc_mod(F.col("i.doc_id"), 10) == 0, F.lit(True)).alias("held_out"),
        F.col("i.n_tokens").alias("n_tokens"),
        (F.col("i.n_tokens") - (F.col("unknown") / F.col("copies")).cast("long") - F.lit(int(ends == 0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("i.base") + F.col("rare_base") / F.col("copies")).alias("base_score"),
        score.alias("score"),
        (score * F.lit(-np.log2(10.0)) / (F.col("i.bytes") + 1)).alias("bits_per_byte"))


COPIES = 4096
INFO = pa.struct([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("bytes", pa.int64())])
