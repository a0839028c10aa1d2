"""Document fingerprints: a homomorphic multiset hash of paragraphs.

Every paragraph (a non-empty line) is hashed to a wide vector; a document's vector is the sum of its
paragraphs' vectors, modulo powers of two. Order does not matter, and a paragraph that comes or goes
is added or subtracted without reading the rest. 32 lanes modulo 2^64 hold a cryptographic hash of
the paragraph, for equality. 512 lanes modulo 2^32 hold signed counts of its byte windows, from
which the likeness of two texts is estimated; a text of less than 2 GB cannot overflow a lane.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklink.llm.common import id_and_text

EXACT, LANES, WINDOW = 32, 512, 8
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xD6E8FEB86659FD93)
MOST_RANGES = 1 << 16  # two numbers each are broadcast
STEP = 1 << 20  # bytes whose windows are hashed at a time


class MultisetHash:
    """A vector that paragraphs can be added to and taken from."""

    def __init__(self):
        self.exact = np.zeros(EXACT, np.uint64)
        self.lanes = np.zeros(LANES, np.int64)  # modulo 2^32 when written

    def add(self, text: str, sign: int = 1) -> MultisetHash:
        """Add (sign 1) or remove (sign -1) all paragraphs of a text."""
        data = text.encode("utf-8", "surrogatepass")
        paragraphs = [p for p in data.split(b"\n") if p]
        for i in range(0, len(paragraphs), 1024):
            wide = b"".join([hashlib.shake_128(p).digest(8 * EXACT) for p in paragraphs[i:i + 1024]])
            total = np.frombuffer(wide, "<u8").reshape(-1, EXACT).sum(axis=0, dtype=np.uint64)
            self.exact = self.exact + total if sign > 0 else self.exact - total
        self.lanes = self.lanes + sign * self._windows(data)
        return self

    @staticmethod
    def _windows(data: bytes) -> np.ndarray:
        """Signed counts of the windows that end at each byte of a line and do not reach beyond its start."""
        total = np.zeros(2 * LANES, np.int64)
        for start in range(0, len(data), STEP):
            skip = min(start, WINDOW - 1)
            raw = np.frombuffer(data[start - skip:start + STEP], np.uint8)
            at = np.arange(len(raw))
            breaks = raw == 10
            line = np.maximum.accumulate(np.where(breaks, at, -1))  # last line break so far
            x, width = raw.astype(np.uint64) + np.uint64(1), 1
            while width < WINDOW:  # a window of twice the width from two neighbours
                factor = np.uint64(pow(BASE, width, 1 << 64))
                x[width:] = x[width:] + np.where(line[width:] < at[:-width], x[:-width] * factor, np.uint64(0))
                width *= 2
            x = x[skip:][~breaks[skip:]]
            x ^= x >> np.uint64(32)
            x *= MIX
            total += np.bincount((x >> np.uint64(54)).astype(np.int64), minlength=2 * LANES)
        return total[:LANES] - total[LANES:]

    def copy(self) -> MultisetHash:
        other = MultisetHash()
        other.exact, other.lanes = self.exact.copy(), self.lanes.copy()
        return other

    def text(self) -> str:
        return self.exact.astype("<u8").tobytes().hex() + self.lanes.astype("<u4").tobytes().hex()

    @classmethod
    def parse(cls, text: str) -> MultisetHash:
        raw, out = bytes.fromhex(text), cls()
        out.exact = np.frombuffer(raw[:8 * EXACT], "<u8").copy()
        out.lanes = np.frombuffer(raw[8 * EXACT:], "<i4").astype(np.int64)
        return out

    def likeness(self, other: MultisetHash) -> float:
        """1 for equal vectors, about 0 for texts with nothing in common; the larger of two estimates."""
        a, b = (v.lanes.astype(np.int32).astype(np.float64) for v in (self, other))
        seen = (a != 0) | (b != 0)
        if not seen.any() or (np.array_equal(self.exact, other.exact) and np.array_equal(a, b)):
            return float(np.array_equal(self.exact, other.exact))
        # what differs weighed by its repetitions, and the angle by the signs of lanes, where one
        # that a side leaves at zero is half an agreement
        weighed = 1.0 - float((a - b) @ (a - b)) / float(a @ a + b @ b)
        product = a * b
        agree = np.where(product > 0, 1.0, np.where(product < 0, 0.0, 0.5))[seen].mean()
        return min(1.0, max(0.0, weighed, float(np.cos(np.pi * (1.0 - agree)))))


def fingerprint(text: str) -> MultisetHash:
    return MultisetHash().add(text)


def edited_text(text: str, following: str) -> str:
    """The last quarter of the characters replaced by the first ones of the next text."""
    part = len(text) // 4
    return text[:len(text) - part] + following[:part]


def updated(vector: MultisetHash, text: str, edited: str, same: int) -> MultisetHash:
    """The fingerprint of `edited`, which agrees with `text` in its first `same` characters.

    Only the paragraphs behind the last line break of the common part are exchanged.
    """
    cut = text.rfind("\n", 0, same) + 1
    return vector.copy().add(text[cut:], -1).add(edited[cut:])


def neighbours(docs: DataFrame, rows: int = 2000) -> DataFrame:
    """Documents dealt to ranges of ids so that each range ends with the document that follows it.

    Columns: bucket, last (whether the row only stands for the next document), doc_id, text. About
    `rows` documents per range, more where that would be over MOST_RANGES ranges; only the ranges' first ids pass
    through the driver and are broadcast. The first document of all follows the last one. Rows of a range are to be read in the
    order of (last, doc_id, text).
    """
    spark = docs.sparkSession
    ids = docs.select("doc_id")
    n = ids.count()
    count = min(MOST_RANGES, max(1, n // rows))
    cuts = np.array([], np.int64)
    if count > 1:
        shares = [i / count for i in range(1, count)]
        found = ids.agg(F.percentile_approx("doc_id", shares, F.lit(10 * count)).alias("cuts")).first().cuts
        cuts = np.unique(np.array(found if found is not None else [], np.int64))

    @F.pandas_udf("long")
    def bucket_of(key: pd.Series) -> pd.Series:
        # a null id comes before all others
        known = key.notna().to_numpy()
        out = np.zeros(len(key), np.int64)
        out[known] = np.searchsorted(cuts, key[known].to_numpy(np.int64), "right")
        return pd.Series(out)

    dealt = docs.withColumn("bucket", bucket_of("doc_id"))
    firsts = dealt.select("bucket", "doc_id").groupBy("bucket").agg(
        F.min("doc_id").alias("id"), F.max(F.col("doc_id").isNull()).alias("none")).collect()
    firsts = sorted((r.bucket, None if r.none else r.id) for r in firsts)
    follows = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    ends = spark.createDataFrame(follows, "first_id long, before long")
    rows_of = dealt.join(F.broadcast(ends), F.col("doc_id").eqNullSafe(F.col("first_id")), "left")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("last"))
    end = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("last"))
    places = F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, end)))
    return rows_of.select(places.alias("place"), "doc_id", "text").select("place.bucket", "place.last", "doc_id", "text")


OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compare(batches):
    """Each row of a range with the one behind it; a range's end row only serves as neighbour."""
    held = None  # bucket, id, text, vector
    for batch in batches:
        out = []
        for bucket, last, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            if held is not None and held[0] != bucket:
                held = None
            if held is None and last:
                continue
            vector = fingerprint(text)
            if held is not None:
                _, own_id, own, mine = held
                edited = edited_text(own, text)
                other = updated(mine, own, edited, len(own) - len(own) // 4)
                out.append((own_id, len(own), hashlib.sha256(edited.encode()).hexdigest(), mine.text(), other.text(),
                            mine.likeness(other), mine.likeness(vector)))
            # of several end rows with one id the first counts
            held = None if last else (bucket, doc_id, text, vector)
        columns = list(zip(*out)) or [()] * len(OUT)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, OUT)], schema=OUT)


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = 2000) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, with their likeness.

    The edited text takes its last quarter from the document with the next id; after
    the last one comes the first. A null text is empty and has the zero fingerprint. Documents with
    one id follow each other in the order of their texts, a null id comes first. An empty
    table gives no rows; other columns are not read. Eager: ids are counted and cut
    into ranges of about `rows` documents; the texts are shuffled once.
    """
    ranges = neighbours(id_and_text(docs, id_col, text_col), rows)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ranges.repartition(parts, "bucket").sortWithinPartitions(
        "bucket", "last", F.col("doc_id").asc_nulls_first(), "text")
    kinds = {"string": "string", "int64": "long", "double": "double"}
    return ordered.mapInArrow(_compare, ", ".join(f"{f.name} {kinds[str(f.type)]}" for f in OUT))
