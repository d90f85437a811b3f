"""Most similar vectors by multiprobe p-stable hashing.

Unit vectors are projected on Gaussian directions and cut into cells of fixed width; a table's key joins the cells of
`depth` directions.  A row visits, besides its own bucket, the perturbed buckets it most likely misses a neighbour in,
in order of estimated success (the smallest sum of squared distances to the crossed cell walls).  Inside a bucket short
codes rank the pairs, and the survivors are ranked again by exact cosine similarity: sign sketches where only pairs from
a given similarity on are sought, else vectors of one byte a dimension.  Copies of one direction collapse to a
representative before and are expanded after, each row to at most k partners of a class.

`depth` grows with the logarithm of the number of rows, so buckets keep their size; the number of tables follows from
depth and from the similarity sought, so that a pair at it is met in some table with a chance over 0.995.  Whole vectors
move by sorted exchanges only: their size grows with the data and is underestimated by the planner.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

from quire.plans.lineage import cut
from quire.plans.runs import whole_runs

WIDTH = 2.0
BITS = 512
#: Chance that two unrelated unit vectors share a cell of one direction at this width.
UNRELATED = 0.486
#: Rows of a bucket beyond which it is cut into blocks, and each block of visitors meets each block of homes.
HOT = 25_000
#: Ids up to which a set of ids may be broadcast (8 bytes each).
SMALL = 200_000
#: Vectors of an Arrow batch that are worked on at a time.
SOME = 1000
SEED = 20


def unit(vector: Column, dims: int = 512) -> Column:
    """The vector at length 1 as float32 bytes; null unless it has `dims` finite values, not all zero."""

    @F.arrow_udf(BinaryType())
    def run(column: pa.Array) -> pa.Array:
        out: list[bytes | None] = []
        for i in range(0, len(column), SOME):
            out += _unit_bytes(column.slice(i, SOME), dims)
        return pa.array(out, pa.binary())

    return run(vector)


def _unit_bytes(column: pa.Array, dims: int) -> list[bytes | None]:
    size = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(size == dims)
    x = column.take(pa.array(right)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(right), dims)
    good = np.isfinite(x).all(axis=1)
    x[~good] = 0
    most = np.abs(x).max(axis=1, initial=0)
    good &= most > 0
    x /= np.where(most > 0, most, 1)[:, None]
    x /= np.where(good, np.linalg.norm(x, axis=1), 1)[:, None]
    rows = x.astype(np.float32)
    out: list[bytes | None] = [None] * len(column)
    for i in np.flatnonzero(good):
        out[right[i]] = rows[i].tobytes()
    return out


def floats(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32).reshape(len(column), dims)


def perturbed(position: np.ndarray, probes: int) -> list[np.ndarray]:
    """Cells of each row's own bucket, then of `probes` perturbed ones by estimated success; position is
    (rows, depth) in cell widths."""
    cell = np.floor(position).astype(np.int64)
    depth = cell.shape[1]
    within = position - cell
    wall = np.concatenate([within, 1 - within], axis=1) ** 2
    near = min(5, 2 * depth)
    order = np.argsort(wall, axis=1)[:, :near]
    cost = np.take_along_axis(wall, order, axis=1)
    subsets = [s for r in (1, 2, 3) for s in itertools.combinations(range(near), r)]
    score = np.empty((len(cell), len(subsets)))
    for i, s in enumerate(subsets):
        total = cost[:, list(s)].sum(axis=1)
        for a, b in itertools.combinations(s, 2):
            total[order[:, a] % depth == order[:, b] % depth] = np.inf
        score[:, i] = total
    best = np.argsort(score, axis=1)[:, :probes]
    out = [cell]
    step = np.zeros((len(subsets), near), dtype=bool)
    for i, s in enumerate(subsets):
        step[i, list(s)] = True
    for t in range(min(probes, best.shape[1])):
        q = cell.copy()
        for place in range(near):
            rows = np.flatnonzero(step[best[:, t], place])
            h = order[rows, place]
            q[rows, h % depth] += np.where(h < depth, -1, 1)
        out.append(q)
    return out


def bucket_keys(x: np.ndarray, depth: int, tables: int, probes: int) -> np.ndarray:
    """(rows, tables, 1 + probes) bucket keys; the first of a table is the row's own."""
    rng = np.random.default_rng(SEED)
    a = rng.standard_normal((x.shape[1], tables * depth)).astype(np.float32)
    shift = rng.random(tables * depth)
    place = (x @ a / WIDTH + shift).reshape(len(x), tables, depth)
    keys = np.zeros((len(x), tables, 1 + probes), dtype=np.uint64)
    for t in range(tables):
        for p, cells in enumerate(perturbed(place[:, t], probes)):
            h = np.full(len(x), (t + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
            for k in range(depth):
                h = (h ^ cells[:, k].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
                h ^= h >> np.uint64(31)
            keys[:, t, p] = h
    return keys.view(np.int64)


def sign_sketch(x: np.ndarray, bits: int = BITS) -> np.ndarray:
    a = np.random.default_rng(SEED + 1).standard_normal((x.shape[1], bits)).astype(np.float32)
    return np.packbits(x @ a > 0, axis=1)


def codes(x: np.ndarray) -> np.ndarray:
    """One byte per dimension behind the scale, so that a row's code times its scale is near the row."""
    top = np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), np.float32(1e-30))
    scale = (top / 127).astype(np.float32)
    return np.concatenate([scale.view(np.uint8), np.rint(x / scale).astype(np.int8).view(np.uint8)], axis=1)


def decoded(column: pa.Array, dims: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), dims + 4)
    return raw[:, 4:].view(np.int8).astype(np.float32) * np.ascontiguousarray(raw[:, :4]).view(np.float32)


_HASHED = StructType(
    [StructField("key", BinaryType()), StructField("sketch", BinaryType()), StructField("cells", ArrayType(LongType()))]
)


def hashed(units: Column, asked: Column, dims: int, depth: int, tables: int, probes: int, bits: int = BITS) -> Column:
    """struct<key of the direction, sketch, bucket keys> of a unit vector; signs of `bits` directions as sketch, or one
    byte a dimension if bits is 0.  Rows that are not asked have their own bucket of each table only."""

    @F.arrow_udf(_HASHED)
    def run(column: pa.Array, ask: pa.Array) -> pa.Array:
        keys, sketches, cells, size = [], [], [np.zeros(0, dtype=np.int64)], [0]
        for i in range(0, len(column), SOME):
            x = floats(column.slice(i, SOME), dims)
            wants = ask.slice(i, SOME).to_numpy(zero_copy_only=False).astype(bool)
            grid = np.rint(x * np.float32(1e5)).astype(np.int32)
            keys += [hashlib.md5(g.tobytes(), usedforsecurity=False).digest() for g in grid]
            sketches += [s.tobytes() for s in (sign_sketch(x, bits) if bits else codes(x))]
            found = np.zeros((len(x), tables, 1 + probes), dtype=np.int64)
            found[wants] = bucket_keys(x[wants], depth, tables, probes)
            found[~wants, :, :1] = bucket_keys(x[~wants], depth, tables, 0)
            used = np.broadcast_to(wants[:, None, None] | (np.arange(1 + probes) == 0), found.shape)
            cells.append(found[used])
            size += used.sum(axis=(1, 2)).tolist()
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(size), pa.int32()), pa.array(np.concatenate(cells)))
        return pa.StructArray.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()), lists], ["key", "sketch", "cells"]
        )

    return run(units, asked)


def most_bits(cosine: float, bits: int) -> int:
    """Differing bits that a pair at this cosine exceeds with a chance of a few in a million."""
    p = math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    return math.ceil(bits * p + 4.5 * math.sqrt(bits * p * (1 - p)))


def _close(table: pa.Table, starts: np.ndarray, cosine: float, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (visitor, home, similarity by sketch) of one bucket after the other within reach of `cosine`."""
    few, all_bits = most_bits(cosine, 128), most_bits(cosine, bits)
    ids, role = table.column("id").to_numpy(), table.column("role").to_numpy()
    words = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint64).reshape(len(ids), bits // 64)
    for s, e in zip(starts[:-1], starts[1:]):
        home, visitor = s + np.flatnonzero(role[s:e] != 1), s + np.flatnonzero(role[s:e] != 0)
        if not len(home) or not len(visitor):
            continue
        h = words[home]
        step = max(1, 1_000_000 // len(home))
        for i in range(0, len(visitor), step):
            v = visitor[i : i + step]
            x = np.bitwise_count(words[v, 0][:, None] ^ h[:, 0]) + np.bitwise_count(words[v, 1][:, None] ^ h[:, 1])
            a, b = np.nonzero(x <= few)
            a, b = v[a], home[b]
            keep = ids[a] != ids[b]
            a, b = a[keep], b[keep]
            differ = np.bitwise_count(words[a] ^ words[b]).sum(axis=1)
            near = differ <= all_bits
            yield ids[a[near]], ids[b[near]], 1.0 - differ[near] / bits


def _best(table: pa.Table, starts: np.ndarray, best: int, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each visitor's `best` homes (visitor, home, similarity by code) of one bucket after the other."""
    ids, role, sketch = table.column("id").to_numpy(), table.column("role").to_numpy(), table.column("sketch").combine_chunks()
    for s, e in zip(starts[:-1], starts[1:]):
        home, visitor = s + np.flatnonzero(role[s:e] != 1), s + np.flatnonzero(role[s:e] != 0)
        if not len(home) or not len(visitor):
            continue
        h, hid = decoded(sketch.take(pa.array(home)), dims), ids[home]
        n = min(best, len(home))
        step = max(1, 2_000_000 // len(home))
        for i in range(0, len(visitor), step):
            v = visitor[i : i + step]
            x = decoded(sketch.take(pa.array(v)), dims) @ h.T
            x[ids[v][:, None] == hid] = -9
            top = np.argpartition(-x, n - 1, axis=1)[:, :n]
            near = np.take_along_axis(x, top, axis=1).ravel()
            real = near > -9
            yield np.repeat(ids[v], n)[real], hid[top.ravel()][real], near[real]


def _met(batches: Iterator[pa.RecordBatch], cosine: float | None, best: int, bits: int, dims: int) -> Iterator[pa.RecordBatch]:
    """Pairs (visitor, home, near) met in a bucket: those within reach of `cosine`, else each visitor's `best`.

    role 0: home only, 1: visitor only, 2: both."""
    for table, starts in whole_runs(batches, "cell"):
        seen = list(_close(table, starts, cosine, bits) if cosine is not None else _best(table, starts, best, dims))
        if seen:
            a, b, near = (np.concatenate(x) for x in zip(*seen))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(near.astype(np.float64))], names=["a", "b", "near"])


def exact(a: Column, b: Column, dims: int) -> Column:
    """Cosine similarity of two unit vectors."""

    @F.arrow_udf(DoubleType())
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        out = np.zeros(len(x))
        for i in range(0, len(x), SOME):
            u, v = floats(x.slice(i, SOME), dims).astype(np.float64), floats(y.slice(i, SOME), dims).astype(np.float64)
            out[i : i + SOME] = np.einsum("ij,ij->i", u, v)
        return pa.array(np.clip(out, -1.0, 1.0))

    return run(a, b)


def depth_for(rows: int, bucket_rows: int) -> int:
    return max(1, round(math.log(max(rows, 1) / bucket_rows) / math.log(1 / UNRELATED))) if rows > bucket_rows else 1


@functools.cache
def met_in_table(cosine: float, depth: int, probes: int, pairs: int = 4000) -> float:
    """Chance that a pair at this cosine similarity meets in one table, from drawn projections: one of the two has its
    own bucket among those that the other visits."""
    rng = np.random.default_rng(SEED + 2)
    a = 50 + rng.random((pairs, depth))
    b = a + rng.standard_normal((pairs, depth)) * math.sqrt(max(0.0, 2 - 2 * cosine)) / WIDTH
    met = np.zeros(pairs, dtype=bool)
    for x, y in ((a, b), (b, a)):
        own = np.floor(y)
        for cells in perturbed(x, probes):
            met |= (cells == own).all(axis=1)
    return float(met.mean())


def tables_for(depth: int, cosine: float = 0.9, probes: int = 4, least: int = 4) -> int:
    """Tables so that a pair at this similarity is missed by all with a chance under 0.005.  A similarity that would
    need over 100 raises: buckets must then be larger (`bucket_rows`) or probes more."""
    met = min(0.95, met_in_table(cosine, depth, probes))
    tables = math.ceil(math.log(0.005) / math.log(1 - met)) if met > 0.05 else 101
    if tables > 100:
        raise ValueError(f"pairs at cosine {cosine} meet too seldom at depth {depth}: raise bucket_rows or probes")
    return max(least, tables)


def _without(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is not in ids, which are broadcast if a count shows that they are few."""
    ids = ids.distinct()
    return rows.join(F.broadcast(ids) if ids.limit(SMALL + 1).count() <= SMALL else ids, "id", "left_anti")


def _only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is in ids; ids is broadcast if a count shows that it is small."""
    ids = ids.distinct()
    return rows.join(F.broadcast(ids) if ids.limit(SMALL + 1).count() <= SMALL else ids, "id", "left_semi")


def most_similar(
    vectors: DataFrame,
    k: int = 5,
    cosine: float | None = None,
    queries: Column | None = None,
    dims: int = 512,
    bucket_rows: int = 1000,
    probes: int = 4,
    least_tables: int = 4,
    rerank: int = 24,
) -> DataFrame:
    """(id, other, similarity): up to k most similar other rows of each row, or of those where `queries` holds.

    vectors has `id` and `embedding`.  With `cosine` only partners at or above it come out, which also makes the
    search cheaper; the number of tables then follows from it.  Without it there are `least_tables`, each visit keeps
    its k + 7 best by code, and a row's `rerank` best are ranked exactly.  Rows with a null id or an unusable vector take
    no part.  Ties go to the smaller id of a class's representative; a repeated id counts once.
    """
    with _small_batches(vectors.sparkSession):
        member, scored = _searched(vectors, k, cosine, queries, dims, bucket_rows, probes, least_tables, rerank)
    return _expanded(member, scored, k)


@contextmanager
def _small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """Arrow batches of so many rows at most for what is run inside: ten thousand pairs of vectors are 40 MB, several
    times over in a task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(old)) if int(old) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _searched(
    vectors: DataFrame, k: int, cosine: float | None, queries: Column | None, dims: int, bucket_rows: int, probes: int, least_tables: int, rerank: int
) -> tuple[DataFrame, DataFrame]:
    """Membership (id, asked, rep) and the similarities (a, b) of representatives, both kept in the shared folder."""
    asked = F.coalesce(queries, F.lit(False)) if queries is not None else F.lit(True)
    units = vectors.filter("id is not null").select("id", asked.alias("asked"), unit(F.col("embedding"), dims).alias("u")).filter("u is not null")
    rows = vectors.filter("id is not null and embedding is not null").count()
    depth = depth_for(rows, bucket_rows)
    tables = tables_for(depth, cosine, probes, least_tables) if cosine is not None else least_tables
    bits = BITS if cosine is not None else 0
    base = units.select("id", "asked", hashed(F.col("u"), F.col("asked"), dims, depth, tables, probes, bits).alias("h"))
    base = cut(base.select("id", "asked", "h.*"))
    # an asked row stands for its class if there is one, so that the class is asked for
    first = base.groupBy("key").agg(F.min_by("id", F.struct(~F.col("asked"), "id")).alias("rep"))
    member = cut(base.select("id", "asked", "key").join(first.hint("merge"), "key").select("id", "asked", "rep").distinct())
    # mostly few rows are copies: taking these out needs no exchange of the sketches
    reps = _without(base.drop("key"), member.filter("id <> rep").select("id"))
    if base.count() > member.count():  # some id comes twice
        reps = reps.dropDuplicates(["id"])
    own = F.when(F.col("asked"), F.col("pos") % (1 + probes) == 0).otherwise(True)
    role = F.when(~F.col("asked"), 0).when(own, 2).otherwise(1).cast("long")
    visits = reps.select("id", "asked", "sketch", F.posexplode("cells").alias("pos", "cell")).select("id", "sketch", "cell", role.alias("role"))
    hot = visits.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("cell", F.ceil(F.col("n") / HOT).cast("long").alias("parts"))
    if (many := hot.limit(10_001).count()) > 0:
        visits = _in_blocks(visits, F.broadcast(hot) if many <= 10_000 else hot)
    met = visits.repartition("cell").sortWithinPartitions("cell").mapInArrow(lambda b: _met(b, cosine, k + 7, bits, dims), "a long, b long, near double")
    if cosine is not None:
        found = cut(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    else:
        met = met.groupBy("a", "b").agg(F.max("near").alias("near"))
        best = Window.partitionBy("a").orderBy(F.desc("near"), "b")
        found = cut(met.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= max(rerank, k)).select("a", "b"))
    used = _only(units.select("id", "asked", "u"), found.select(F.col("a").alias("id")).union(found.select(F.col("b").alias("id"))))
    left = (used.filter("asked") if cosine is None else used).select(F.col("id").alias("a"), F.col("u").alias("ua")).dropDuplicates(["a"])
    right = used.select(F.col("id").alias("b"), F.col("u").alias("ub")).dropDuplicates(["b"])
    scored = found.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    scored = cut(scored.select("a", "b", exact(F.col("ua"), F.col("ub"), dims).alias("similarity")))
    if cosine is not None:
        scored = scored.filter(F.col("similarity") >= cosine)
        scored = scored.unionByName(scored.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
    return member, scored


def _in_blocks(visits: DataFrame, hot: DataFrame) -> DataFrame:
    """visits with each bucket of hot (cell, parts) cut into cells of one block of visitors and one of homes."""
    spread = visits.join(hot, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    spread = spread.withColumn("mine", F.pmod(F.xxhash64("id"), "parts"))
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)

    def to(v: Column, h: Column, role: Column) -> Column:
        return F.struct(v.cast("long").alias("v"), h.cast("long").alias("h"), role.cast("long").alias("role"))

    mine, both, none = F.col("mine"), F.col("role") == 2, F.expr("cast(array() as array<struct<v:bigint,h:bigint,role:bigint>>)")
    visiting = F.when(F.col("role") > 0, F.transform(every, lambda j: to(mine, j, F.when(both & (j == mine), 2).otherwise(1)))).otherwise(none)
    at_home = F.when(F.col("role") != 1, F.transform(F.filter(every, lambda i: ~both | (i != mine)), lambda i: to(i, mine, F.lit(0)))).otherwise(none)
    spread = spread.select("id", "sketch", "cell", F.explode(F.concat(visiting, at_home)).alias("t"))
    return spread.select("id", "sketch", F.xxhash64("cell", "t.v", "t.h").alias("cell"), "t.role")


def _expanded(member: DataFrame, scored: DataFrame, k: int) -> DataFrame:
    """Rows' own k best from the similarities of representatives: copies first, then the classes next to theirs."""
    best = Window.partitionBy("a").orderBy(F.desc("similarity"), "b")
    scored = scored.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k).drop("n")
    head = member.select("rep", F.col("id").alias("other")).distinct()
    head = head.withColumn("n", F.row_number().over(Window.partitionBy("rep").orderBy("other"))).filter(F.col("n") <= k + 1).drop("n")
    asking = member.filter("asked").select("id", "rep")
    copies = asking.join(head.hint("merge"), "rep").filter("id <> other").select("id", "other", F.lit(1.0).alias("similarity"))
    beside = asking.join(scored.withColumnRenamed("a", "rep").hint("merge"), "rep").select("id", "b", "similarity")
    beside = beside.join(head.withColumnRenamed("rep", "b").hint("merge"), "b").select("id", "other", "similarity")
    mine = Window.partitionBy("id").orderBy(F.desc("similarity"), "other")
    every = copies.unionByName(beside)
    return every.withColumn("n", F.row_number().over(mine)).filter(F.col("n") <= k).select("id", "other", "similarity")
