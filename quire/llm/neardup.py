"""Near-duplicate texts by HyperMinHash sketches.

Texts are compared as sets of character 5-grams of their lower-cased, white-space-collapsed form.  A sketch has four
independent hash functions of 64 buckets; a bucket keeps the leading-zero count and four mantissa bits of its
smallest hash.  Empty buckets borrow from a full one chosen by their number, so short texts band like long ones.
Bands of compressed registers give candidates, the collision-corrected estimate drops most false ones, and the exact
similarity decides.  Exact copies collapse to one representative before any of this.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

from quire.operators.components import connected
from quire.plans.lineage import cut
from quire.plans.runs import pairs_within, whole_runs

SHINGLE = 5
HASHES, BUCKETS = 4, 64
REGISTERS = HASHES * BUCKETS
MANTISSA = 4
#: Chance with which a pair at the threshold may share no band.
MISSED = 0.0005
#: Standard errors below the threshold at which the estimate drops a candidate.
SLACK = 5.0
#: Longest run of one band value that is paired outright; longer ones go through blocks.
RUN = 64
TEXTS = 500

_MUL = np.uint64(0x9E3779B97F4A7C15)


def canonical(text: str) -> str:
    return " ".join(text.lower().split())


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = x ^ np.uint64((seed * 0xD1B54A32D192ED03 + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def registers(texts: list[str], seed: int = 0) -> np.ndarray:
    """One row of compressed registers per canonical text; a text without a shingle has zeros."""
    n = len(texts)
    size = np.fromiter(map(len, texts), dtype=np.int64, count=n)
    code = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    grams = np.maximum(size - SHINGLE + 1, 0)
    if not grams.sum():
        return np.zeros((n, REGISTERS), dtype=np.uint8)
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    owner = np.repeat(np.arange(n), grams)
    at = np.arange(int(grams.sum())) - np.repeat(np.concatenate([[0], np.cumsum(grams)])[:-1] - start, grams)
    rolling = np.zeros(max(0, len(code) - SHINGLE + 1), dtype=np.uint64)
    for k in range(SHINGLE):
        rolling = rolling * _MUL + code[k : k + len(rolling)] + np.uint64(1)
    gram = rolling[at]
    least = np.full(n * REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for h in range(HASHES):
        x = mixed(gram, seed * HASHES + h + 1)
        slot = owner * REGISTERS + h * BUCKETS + (x >> np.uint64(58)).astype(np.int64)
        np.minimum.at(least, slot, x & np.uint64((1 << 58) - 1))
    empty = (least == np.iinfo(np.uint64).max).reshape(n, REGISTERS)
    bits = np.where(empty.ravel(), 1, least).astype(np.float64).view(np.uint64)
    zeros = np.minimum(57 - np.minimum((bits >> np.uint64(52)).astype(np.int64) - 1023, 57), 15)
    low = (bits >> np.uint64(52 - MANTISSA)).astype(np.int64) & ((1 << MANTISSA) - 1)
    reg = (zeros << MANTISSA | low).astype(np.uint8).reshape(n, REGISTERS)
    none = empty.all(axis=1)
    reg[none] = 0
    open_rows, open_cols = np.nonzero(empty & ~none[:, None])
    attempt = 0
    while len(open_rows):
        attempt += 1
        source = (mixed(open_cols.astype(np.uint64) + np.uint64(attempt * REGISTERS), 99) % np.uint64(REGISTERS)).astype(np.int64)
        full = ~empty[open_rows, source]
        reg[open_rows[full], open_cols[full]] = reg[open_rows[full], source[full]]
        open_rows, open_cols = open_rows[~full], open_cols[~full]
    return reg


def rows_for(threshold: float) -> int:
    """Registers to a band: as many as let a pair at the threshold share a band but for a chance of MISSED; 6 at 0.75, 7 at
    0.8.  A threshold that not even single registers reach raises."""
    for rows in range(7, 0, -1):
        if (1 - threshold**rows) ** (REGISTERS // rows) <= MISSED:
            return rows
    raise ValueError(f"{REGISTERS} registers cannot find pairs at {threshold}")


def band_values(reg: np.ndarray, rows: int = 6) -> np.ndarray:
    """One 64-bit value per band of so many registers; the band's number is part of it."""
    count = REGISTERS // rows
    r = reg[:, : count * rows].reshape(len(reg), count, rows).astype(np.uint64)
    packed = np.zeros(r.shape[:2], dtype=np.uint64)
    for k in range(rows):
        packed = packed << np.uint64(8) | r[:, :, k]
    return mixed(packed * np.uint64(REGISTERS) + np.arange(count, dtype=np.uint64), 7).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from two register matrices, less the matches that chance alone gives."""
    chance = 0.72 / 4 / (1 << MANTISSA)
    return np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1)


def jaccard(a: str, b: str) -> float:
    """Exact similarity of two texts; identical canonical texts have 1 even without a shingle."""
    a, b = canonical(a), canonical(b)
    if a == b:
        return 1.0
    x = {a[i : i + SHINGLE] for i in range(len(a) - SHINGLE + 1)}
    y = {b[i : i + SHINGLE] for i in range(len(b) - SHINGLE + 1)}
    both = len(x & y)
    return both / (len(x) + len(y) - both) if both else 0.0


_SKETCH = StructType([StructField("key", BinaryType()), StructField("regs", BinaryType())])


def sketch(text: Column) -> Column:
    """struct<key: 16-byte content key, regs: registers> of a text."""

    @F.arrow_udf(_SKETCH)
    def run(column: pa.Array) -> pa.Array:
        keys, regs = [], []
        for i in range(0, len(column), TEXTS):
            texts = [canonical(t or "") for t in column.slice(i, TEXTS).to_pylist()]
            keys += [hashlib.md5(t.encode(), usedforsecurity=False).digest() for t in texts]
            regs += [r.tobytes() for r in registers(texts)]
        return pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(regs, pa.binary())], ["key", "regs"])

    return run(text)


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), REGISTERS)


def bands(regs: Column, rows: int) -> Column:
    @F.arrow_udf(ArrayType(LongType()))
    def run(column: pa.Array) -> pa.Array:
        v = band_values(matrix(column), rows)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * v.shape[1], pa.int32()), pa.array(v.ravel()))

    return run(regs)


def estimated(a: Column, b: Column) -> Column:
    @F.arrow_udf(DoubleType())
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array(estimate(matrix(x), matrix(y)))

    return run(a, b)


def similarity(a: Column, b: Column) -> Column:
    @F.arrow_udf(DoubleType())
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([jaccard(s or "", t or "") for s, t in zip(x.to_pylist(), y.to_pylist())], pa.float64())

    return run(a, b)


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of ids in one run; a run over RUN gives its members instead, with its value in `hot`."""
    for table, starts in whole_runs(batches, "band"):
        ids, band = table.column("id").to_numpy(), table.column("band").to_numpy()
        size = np.diff(starts)
        per = np.repeat(size, size)
        short = per <= RUN
        s = np.concatenate([[0], np.cumsum(size[size <= RUN])])
        i, j = pairs_within(s)
        few, hot = ids[short], ~short
        a, b = few[i], few[j]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([np.minimum(a, b), ids[hot]])),
                pa.array(np.concatenate([np.maximum(a, b), ids[hot]])),
                pa.array(np.concatenate([np.zeros(len(a), dtype=np.int64), band[hot]]), mask=np.arange(len(a) + hot.sum()) < len(a)),
            ],
            names=["id_a", "id_b", "hot"],
        )


def _block_pairs(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs inside one block-by-block cell whose estimate reaches `least`."""
    for table, starts in whole_runs(batches, "cell"):
        ids, side = table.column("id").to_numpy(), table.column("side").to_numpy()
        reg = matrix(table.column("regs").combine_chunks())
        for s, e in zip(starts[:-1], starts[1:]):
            left, right = np.flatnonzero(side[s:e] != 1) + s, np.flatnonzero(side[s:e] != 0) + s
            for i in left:
                other = right[ids[right] > ids[i]] if (side[s:e] == 2).all() else right
                if not len(other):
                    continue
                hit = other[estimate(np.broadcast_to(reg[i], (len(other), REGISTERS)), reg[other]) >= least]
                a, b = np.full(len(hit), ids[i]), ids[hit]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["id_a", "id_b"])


def hot_pairs(members: DataFrame, reps: DataFrame, least: float, block: int = 256) -> DataFrame:
    """Candidates of long runs: each run is cut into blocks, each pair of blocks is one cell of bounded size."""
    n = members.groupBy("hot").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks"))
    own = members.join(n, "hot").join(reps.select(F.col("id").alias("id_a"), "regs"), "id_a")
    own = own.withColumn("mine", F.pmod(F.xxhash64("id_a"), F.col("blocks")))
    cells = own.select("hot", "mine", F.col("id_a").alias("id"), "regs", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("other"))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    side = F.when(low == high, 2).when(F.col("mine") == low, 0).otherwise(1)
    cells = cells.select(F.xxhash64("hot", low, high).alias("cell"), "id", side.cast("long").alias("side"), "regs")
    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(lambda b: _block_pairs(b, least), "id_a long, id_b long")


def classes(docs: DataFrame, least_chars: int) -> tuple[DataFrame, DataFrame]:
    """(id, rep) of every long enough text, rep being the smallest id with the same canonical text; and the
    representatives' registers."""
    long_enough = docs.filter(F.length("text") >= least_chars).filter(F.col("id").isNotNull())
    s = cut(long_enough.select("id", sketch(F.col("text")).alias("s")).select("id", "s.key", "s.regs"))
    first = s.groupBy("key").agg(F.min("id").alias("rep"))
    member = s.select("id", "key").join(first, "key").select("id", "rep")
    reps = s.join(first.select(F.col("rep").alias("id"), F.col("key")), ["id", "key"], "left_semi").dropDuplicates(["id"])
    return member, reps.select("id", "regs")


def similar_classes(docs: DataFrame, threshold: float = 0.8, least_chars: int = 0) -> tuple[DataFrame, DataFrame]:
    """Membership (id, rep) and the pairs (id_a, id_b, similarity) of representatives at or above the threshold.

    docs has `id` and `text`.  Null texts, null ids and texts under `least_chars` code points take no part.  Pairs of
    one class are not expanded.
    """
    member, reps = classes(docs, least_chars)
    reps = cut(reps)
    least = threshold - SLACK * (threshold * (1 - threshold) / REGISTERS) ** 0.5
    banded = reps.filter(F.col("regs") != F.lit(bytearray(REGISTERS))).select("id", F.explode(bands(F.col("regs"), rows_for(threshold))).alias("band"))
    raw = banded.repartition("band").sortWithinPartitions("band").mapInArrow(_paired, "id_a long, id_b long, hot long")
    raw = cut(raw.distinct())
    a, b = reps.select(F.col("id").alias("id_a"), F.col("regs").alias("ra")), reps.select(F.col("id").alias("id_b"), F.col("regs").alias("rb"))
    close = raw.filter("hot is null").select("id_a", "id_b").join(a, "id_a").join(b, "id_b")
    close = close.filter(estimated(F.col("ra"), F.col("rb")) >= least).select("id_a", "id_b")
    hot = raw.filter("hot is not null")
    if not hot.isEmpty():
        close = close.unionByName(hot_pairs(hot, reps, least)).distinct()
    text = docs.filter(F.length("text") >= least_chars)
    ta, tb = text.select(F.col("id").alias("id_a"), F.col("text").alias("ta")), text.select(F.col("id").alias("id_b"), F.col("text").alias("tb"))
    checked = close.join(ta, "id_a").join(tb, "id_b").select("id_a", "id_b", similarity(F.col("ta"), F.col("tb")).alias("similarity"))
    return member, checked.filter(F.col("similarity") >= threshold)


def similar_pairs(docs: DataFrame, threshold: float, least_chars: int = 0) -> DataFrame:
    """Every pair (id_a < id_b) of rows at or above the threshold, copies included."""
    member, pairs = similar_classes(docs, threshold, least_chars)
    member, pairs = cut(member), pairs.select("id_a", "id_b")
    more = member.groupBy("rep").count().filter("count > 1").select("rep")
    a, b = member.select(F.col("rep").alias("id_a"), F.col("id").alias("a")), member.select(F.col("rep").alias("id_b"), F.col("id").alias("b"))
    across = pairs.join(a, "id_a").join(b, "id_b").select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))
    copies = member.join(more, "rep", "left_semi")
    within = copies.select("rep", F.col("id").alias("id_a")).join(copies.select("rep", F.col("id").alias("id_b")), "rep").filter("id_a < id_b")
    return across.unionByName(within.select("id_a", "id_b")).distinct()


def groups(docs: DataFrame, threshold: float = 0.8, least_chars: int = 0) -> DataFrame:
    """One row per text that takes part: id, class_id (smallest id linked to it, through others too), class_size."""
    member, pairs = similar_classes(docs, threshold, least_chars)
    member = cut(member)
    linked = connected(pairs.select(F.col("id_a").alias("src"), F.col("id_b").alias("dst")))
    named = member.join(linked.select(F.col("node").alias("rep"), "component"), "rep", "left")
    named = named.select("id", F.coalesce("component", "rep").alias("class_id"))
    return named.join(named.groupBy("class_id").agg(F.count("*").alias("class_size")), "class_id").select("id", "class_id", "class_size")
