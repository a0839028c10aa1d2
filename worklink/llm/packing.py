"""Packing of token pieces into sequences: shortest pack first over the length histogram.

The histogram of piece lengths has at most `size` entries however many documents there are, so the
placement runs on it alone. Lengths go longest first into the pack with the smallest sum that is
open, a whole count of equal packs at a time. What comes out is a list of patterns with counts.
Pieces of equal length are then numbered, and rank ranges of a length join them to pattern slots.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from worklink.llm.bpe import byte_characters, merge
from worklink.llm.common import Recent, id_and_text, stored

PIECE = pa.schema([(n, pa.int64()) for n in ("doc_id", "row", "start", "length", "ids_crc32", "doc_tokens")])
ODD_SPACE = regex.compile("[\x1c-\x1f]")


@dataclass
class Pattern:
    """`count` packs that each hold one piece of every length in `lengths`."""

    lengths: tuple[int, ...]
    count: int


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[Pattern]:
    """Pack a histogram {length: count}; every length is between 1 and `size`.

    Open packs are kept by their free room. A length goes into the packs with the
    most room (the shortest packs), as many at a time as both sides have, and opens
    new ones, filled with as many copies as fit, where no pack has room. Deterministic.
    """
    rooms: dict[int, list[Pattern]] = {}
    closed: list[Pattern] = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r in rooms if rooms[r] and r >= length), default=0)
            if room:
                pack = rooms[room].pop()
                # equal packs take equally many copies, at most what fits
                each = max(1, min(room // length, left // pack.count))
            else:
                each = min(size // length, left)
                pack, room = Pattern((), left // each), size
            used = min(pack.count, left // each)
            if used < pack.count:
                rooms[room].append(Pattern(pack.lengths, pack.count - used))
            filled = Pattern(pack.lengths + (length,) * each, used)
            left -= used * each
            rest = room - length * each
            (rooms.setdefault(rest, []) if rest else closed).append(filled)
    return closed + [p for packs in rooms.values() for p in packs]


class Slots:
    """Rank ranges of each length and the sequence and offset that they go to."""

    def __init__(self, patterns: list[Pattern], size: int):
        self.shift = 1 << 44  # above any rank of a length
        taken: Counter = Counter()
        rows, base = [], 0
        for p in patterns:
            offset = 0
            for length in p.lengths:
                rows.append((length * self.shift + taken[length], base, offset))
                taken[length] += p.count
                offset += length
            base += p.count
        rows.sort()
        self.key, self.base, self.offset = (np.array([r[i] for r in rows], np.int64) for i in range(3))

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = length * self.shift + rank
        at = np.searchsorted(self.key, key, "right") - 1
        return self.base[at] + key - self.key[at], self.offset[at]


class PieceCutter:
    """Token ids of whole texts as bytes, and the pieces that they are cut into.

    White space never lies inside a token of the vocabularies this is made for, so
    ids are found for each run of other characters and remembered. Runs are encoded by the tokenizers
    library; a plain word, with or without signs behind it, by its merge list.
    """

    def __init__(self, spec: str, size: int, end_id: int):
        self.spec, self.size = spec, size
        self.end = np.uint32(end_id).astype("<u4").tobytes()
        self.__setstate__(self.__dict__)

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("spec", "size", "end")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.tokenizer = Tokenizer.from_str(self.spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        model = json.loads(self.spec)["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        shown = {b: c for c, b in byte_characters().items()}
        self.inner = [vocab.get(shown[b]) for b in range(256)]
        self.last = [vocab.get(shown[b] + suffix) for b in range(256)]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(vocab[a], vocab[b]): r for r, (a, b) in reversed(list(enumerate(pairs)))}
        self.made = [vocab[a + b] for a, b in pairs]
        self.words = Recent(self.ids, limit=400_000)

    def ids(self, run: str) -> bytes:
        word = run.rstrip(".,;:!?|#$%&*").lower()
        # letters of one byte in Latin-1 are their own normal form and have a small letter of one character
        if word.isalpha() and max(run) < "\u0100":
            behind = run[len(word):]
            if word != run:
                return self.words[word] + (self.words[behind] if behind else b"")
            data = word.encode()
            symbols = [self.inner[b] for b in data]
            symbols[-1] = self.last[data[-1]]
            return array("I", merge(symbols, self.ranks, self.made)).tobytes()
        return array("I", self.tokenizer.encode(run, add_special_tokens=False).ids).tobytes()

    def encoded(self, text: str) -> bytes:
        # str.split also cuts at four control characters that are no white space to the tokenizer
        words = regex.split(r"\s+", text) if ODD_SPACE.search(text) else text.split()
        return b"".join(map(self.words.__getitem__, words)) + self.end

    def pieces(self, text: str) -> tuple[int, list[int], list[int], list[int]]:
        """Tokens of the document; start, length and checksum of each piece."""
        data = self.encoded(text)
        total = len(data) // 4
        starts = list(range(0, total, self.size))
        return (total, starts, [min(self.size, total - s) for s in starts],
                [zlib.crc32(data[4 * s: 4 * (s + self.size)]) for s in starts])


def cut_pieces(docs: DataFrame, vocabulary: str, size: int, end_id: int) -> DataFrame:
    """One row per piece; `row` tells documents with the same id apart (a hash of the text)."""
    with open(vocabulary, encoding="utf-8") as file:
        cutter = docs.sparkSession.sparkContext.broadcast(PieceCutter(file.read(), size, end_id))

    def run(batches):
        for batch in batches:
            docs_of, marks, starts, lengths, sums, totals = [], [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total, start, length, crc = cutter.value.pieces(text)
                docs_of += [doc_id] * len(start)
                marks += [zlib.crc32(text.encode())] * len(start)
                totals += [total] * len(start)
                starts, lengths, sums = starts + start, lengths + length, sums + crc
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (docs_of, marks, starts, lengths, sums, totals)], schema=PIECE)

    return docs.mapInArrow(run, ", ".join(f"`{n}` long" for n in PIECE.names))


def ranked(pieces: DataFrame, shards: int) -> DataFrame:
    """Number the pieces of each length from 0 without bringing a length together.

    Rows of a length are dealt to shards by a hash; a row's number is the size of
    the shards before its own plus its place within it. Rows that agree in all
    columns are interchangeable, so ties do no harm.
    """
    order = ["doc_id", "start", "row", "ids_crc32"]
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(*order), F.lit(shards)))
    sizes = dealt.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("length", "shard").orderBy(*order)) - 1
    return dealt.withColumn("place", place).join(firsts, ["length", "shard"]).withColumn("rank", F.col("first") + F.col("place"))


def pack(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1, shard_rows: int = 100_000,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most `size` tokens.

    A document is the ids of its whole text followed by `end_id`; a null or empty
    text is that id alone. It is cut every `size` ids. One row per piece: doc_id,
    start, length, ids_crc32, doc_tokens, sequence_id, offset. Repeated rows are
    packed once each, a null id stays null, an empty table gives no rows, other
    columns are not read. Eager: the pieces are written to the shared folder, and
    their histogram (`size` entries at most) is read on the driver. Pieces of a length are numbered in shards of
    about `shard_rows`.
    """
    spark = docs.sparkSession
    pieces = stored(cut_pieces(id_and_text(docs, id_col, text_col), vocabulary, size, end_id), "pieces")
    counted = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    patterns = shortest_pack_first(counted, size)
    shards = -(-max(counted.values(), default=1) // shard_rows)
    slots = spark.sparkContext.broadcast(Slots(patterns, size))

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            sequence, offset = slots.value.of(length, rank)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    rows = ranked(pieces, shards).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank")
    return rows.mapInArrow(
        place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long")
