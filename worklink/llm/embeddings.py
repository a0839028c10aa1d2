"""Near duplicates among vectors: random-hyperplane signs in several tables, exact cosines, components.

Vectors whose signs agree in all planes of a table are compared by cosine in double precision. A pair
that meets in several tables counts in the first only, so links need no distinct.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklink.llm.common import stored
from worklink.llm.components import connected_components, spanning

BUCKET = 16  # unrelated vectors that share a bucket
BLOCK = 512  # vectors of a bucket that are compared with each other at a time


def tables_needed(cosine: float, planes: int, miss: float) -> int:
    """Tables after which a pair at exactly `cosine` has met nowhere with chance `miss`."""
    together = (1 - math.acos(cosine) / math.pi) ** planes
    return max(1, math.ceil(math.log(miss) / math.log1p(-together)))


class Hyperplanes:
    """Random planes by dimension; the seed fixes them on every executor."""

    def __init__(self, planes: int, tables: int, seed: int = 3):
        self.planes, self.tables, self.seed = planes, tables, seed

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Signs of the rows of x as one number per table."""
        normals = np.random.default_rng([self.seed, x.shape[1]]).standard_normal((x.shape[1], self.planes * self.tables))
        signs = (x @ normals >= 0).reshape(len(x), self.tables, self.planes)
        return signs @ (1 << np.arange(self.planes))


def signed(vectors: DataFrame, hyper: Hyperplanes) -> DataFrame:
    """(vec_id, vector, dim, codes); vector is the unit vector's bytes, null where it has none."""

    def run(batches):
        for batch in batches:
            ids, values = batch.column(0).to_pylist(), batch.column(1)
            if isinstance(values, pa.ChunkedArray):
                values = values.combine_chunks()
            sizes = np.diff(np.asarray(values.offsets))
            flat = values.values.slice(values.offsets[0].as_py(), int(sizes.sum()))
            whole = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # a null component turns into NaN
            ends = np.cumsum(sizes)
            known = np.asarray(values.is_valid())
            vector: list = [None] * len(ids)
            code: list = [None] * len(ids)
            for dim in np.unique(sizes):
                rows = np.flatnonzero((sizes == dim) & known)
                if not dim or not len(rows):
                    continue
                x = whole[(ends[rows] - dim)[:, None] + np.arange(dim)] + 0.0
                with np.errstate(all="ignore"):
                    top = np.abs(x).max(axis=1, keepdims=True)
                    x = x / top  # so that neither large nor tiny numbers leave the range when squared
                    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                fine = np.isfinite(x).all(axis=1)
                codes = hyper.codes(np.where(fine[:, None], x, 0.0))
                for i, row in enumerate(rows):
                    if fine[i]:
                        vector[row], code[row] = x[i].tobytes(), codes[i].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(vector, pa.binary()), pa.array(sizes, pa.int32()), pa.array(code, pa.list_(pa.int64()))],
                names=["vec_id", "vector", "dim", "codes"])

    return vectors.mapInArrow(run, "vec_id long, vector binary, dim int, codes array<long>")


def bucket_rows(reps: DataFrame, tables: int) -> DataFrame:
    """One row per table, bucket and pair of blocks that a vector has to be in.

    A bucket of more than BLOCK vectors is dealt to blocks by a hash of the id, and every pair of blocks is
    a group of its own, so no task holds a bucket as a whole.
    """
    placed = reps.select("rep", "vector", "copies", "dim", "codes", F.posexplode("codes").alias("table", "code"))
    keys = ["dim", "table", "code"]
    sizes = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    large = stored(sizes.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")), "buckets")
    met = placed.join(large, keys)
    own = F.pmod(F.xxhash64("rep", "table"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    spread = met.withColumn("own", own).withColumn("other", F.explode(others))
    return spread.select(
        *keys, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "rep", "copies", "vector", "codes")


def compare(limit: float):
    """Links within each group of rows that come sorted by group, exact and each pair once."""

    def group(table, low, high, own, reps, copies, vectors, codes):
        x = np.frombuffer(b"".join(vectors), np.float64).reshape(len(reps), -1)
        codes = np.array(codes, np.int64)
        # rows against columns: a block against itself takes each pair once, else one block against the other
        a = np.arange(len(reps)) if low == high else np.flatnonzero(own == low)
        b = a if low == high else np.flatnonzero(own == high)
        i, j = np.nonzero(x[a] @ x[b].T >= limit)
        if low == high:
            i, j = i[i < j], j[i < j]
        i, j = a[i], b[j]
        if table:  # already met in an earlier table
            new = ~(codes[i, :table] == codes[j, :table]).any(axis=1)
            i, j = i[new], j[new]
        links = np.bincount(i, weights=copies[j], minlength=len(reps)) + np.bincount(j, weights=copies[i], minlength=len(reps))
        return links.astype(np.int64), i, j

    def run(batches):
        held, key = [], None

        def closed():
            if len(held) < 2:
                return None
            _, table, _, low, high = key
            own, reps, copies, vectors, codes = zip(*held)
            reps = np.array(reps, np.int64)
            links, i, j = group(table, low, high, np.array(own), reps, np.array(copies, np.int64), vectors, codes)
            if not len(i):
                return None
            edges = list(spanning(reps[i].tolist(), reps[j].tolist()))
            linked = np.flatnonzero(links)
            ids = reps[linked].tolist() + [a for a, _ in edges]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(links[linked].tolist() + [None] * len(edges), pa.int64()),
                 pa.array([None] * len(linked) + [b for _, b in edges], pa.int64())], names=["rep", "links", "other"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:5] != key:
                    if (out := closed()) is not None:
                        yield out
                    held, key = [], row[:5]
                held.append(row[5:])
        if (out := closed()) is not None:
            yield out

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.95, planes: int | None = None, miss: float = 0.001,
                 id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept for every vector.

    Two vectors of one dimension link when their cosine is at least `cosine`. The number of tables is such
    that a pair at exactly `cosine` is missed with chance `miss`, closer ones less often. Unless `planes` is given it
    grows with the number of vectors, so that about BUCKET unrelated ones share a bucket. A vector that is null, empty, zero or holds a
    null or non-finite component links with nothing. Equal vectors are compared as
    one and count as links of each other. Rows that repeat an id are one vector if they
    agree, else the id has the links of all. A null id stays null and links with nothing. Eager:
    links and components are computed at once; other columns are not read.
    """
    planes = planes or max(4, math.ceil(math.log2(max(1, vectors.count()) / BUCKET)))
    hyper = Hyperplanes(planes, tables_needed(cosine, planes, miss))
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    signs = stored(signed(source, hyper), "signs")
    fine = signs.filter(F.col("vector").isNotNull() & F.col("vec_id").isNotNull())
    # the unit vector's digest stands for it; copies are counted before the shuffle
    digest = F.sha2("vector", 256).alias("digest")
    members = fine.select("vec_id", digest).distinct()
    copies = members.groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    copies = stored(copies, "copies")
    first = fine.select(F.col("vec_id").alias("rep"), digest, "vector", "dim", "codes")
    reps = stored(first.join(copies, ["rep", "digest"]).dropDuplicates(["rep", "digest"]).drop("digest"), "reps")
    group = ["dim", "table", "code", "low", "high"]
    rows = bucket_rows(reps, hyper.tables)
    spread = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(spread, *group).sortWithinPartitions(*group).select(
        *group, "own", "rep", "copies", "vector", "codes")
    found = stored(ordered.mapInArrow(compare(cosine), "rep long, links long, other long"), "links")
    parts = connected_components(found.filter("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    links = found.filter("links is not null").groupBy("rep").agg(F.sum("links").alias("links"))
    of_rep = copies.join(links, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    of_vector = members.join(of_rep, "digest").groupBy("vec_id").agg(
        F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return source.select("vec_id").join(of_vector, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.coalesce("component_id", "vec_id").eqNullSafe(F.col("vec_id"))).alias("kept"))
