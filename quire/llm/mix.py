"""Mixing sources to target weights along a time-varying curriculum.

Size is counted in tokens.  A source's weight over training time t in [0, 1] is its share s times 1 + k (2t - 1): a
slope k > 0 moves it towards the end, k < 0 to the start, and the integral over all of training stays s.  A document
copy that lies at fraction u of its source's cumulative demand gets the position t at which the integral reaches u,
the root of k t^2 + (1 - k) t = u.  Range-sorting all copies by t gives the training order.

Running totals over a source are taken in two steps, within hash ranges of bounded size and over the ranges' sums, so
no source is ever in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import bpe
from quire.plans.lineage import cut

#: Documents that one hash range of a source holds on average.
RANGE = 20_000
#: Slope of sources that are repeated against those that are not; what is repeated comes late.
TILT = 0.5


#: Rows up to which a list of sources is broadcast.
SOURCES = 10_000


def _few(listed: DataFrame) -> DataFrame:
    """A table of one row per source, to be broadcast if a count shows that it is small."""
    return F.broadcast(listed) if listed.limit(SOURCES + 1).count() <= SOURCES else listed


def label(c: Column | str) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", path: str | None = None) -> DataFrame:
    """(doc_id, source, n_tokens) with trimmed lower-case labels; documents without a label or token are left out."""
    d = docs.select(F.col(id_col).alias("doc_id"), label(source_col).alias("source"), F.col(text_col).alias("text"))
    d = d.filter("source <> '' and doc_id is not null and length(text) > 0")
    return d.select("doc_id", "source", bpe.count(F.col("text"), path).alias("n_tokens"))


def plan(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """One row per target: source, target_share, max_repeats, docs, have (tokens), demand (tokens), slope.

    Without `total_tokens` the total is the largest that every source with documents can fill at its share, so the
    shares of these hold to a document; a target without documents gets none, and its share goes to the others in
    proportion.  With it, a source's demand is cut at have times max_repeats and the rest is again shared out by
    share, until all is placed or every source is full.
    """
    have = docs.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n_tokens").cast("double").alias("have"))
    t = targets.select(label("source").alias("source"), F.col("target_share").cast("double").alias("target_share"), F.greatest(F.col("max_repeats"), F.lit(0)).alias("max_repeats"))
    t = t.filter("source <> ''").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    t = t.join(have, "source", "left").fillna(0, ["docs", "have", "target_share", "max_repeats"])
    t = t.withColumn("most", F.col("have") * F.col("max_repeats"))
    every = Window.partitionBy()
    usable = F.when((F.col("most") > 0) & (F.col("target_share") > 0), F.col("target_share"))
    # a table of targets is as small as the list of sources: one window over it is no gathering of the corpus
    t = t.withColumn("share", F.coalesce(usable / F.sum(usable).over(every), F.lit(0.0)))
    if total_tokens is None:
        t = t.withColumn("demand", F.coalesce(F.col("share") * F.min(F.when(F.col("share") > 0, F.col("most") / F.col("share"))).over(every), F.lit(0.0)))
    else:
        # water filling: the level rises source by source in the order in which they fill up
        rank = Window.partitionBy().orderBy(F.when(F.col("share") > 0, F.col("most") / F.col("share")).asc_nulls_first(), "source")
        before = rank.rowsBetween(Window.unboundedPreceding, -1)
        after = rank.rowsBetween(0, Window.unboundedFollowing)
        level = (F.lit(float(total_tokens)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("share").over(after)
        # the first source that is not full at its level sets it for all that come after
        open_ = (F.col("share") > 0) & (level * F.col("share") <= F.col("most"))
        t = t.withColumn("at", F.row_number().over(rank)).withColumn("level", F.when(open_, F.struct("at", level.alias("level"))))
        first = F.min("level").over(every)["level"]
        t = t.withColumn("demand", F.least(F.col("most"), F.coalesce(first * F.col("share"), F.col("most"))))
    again = (F.col("demand") > F.col("have")).cast("double")
    part = F.when(F.sum("demand").over(every) > 0, F.col("demand") / F.sum("demand").over(every)).otherwise(0.0)
    t = t.withColumn("again", again).withColumn("part", part)
    slope = F.lit(TILT) * (F.col("again") - F.sum(F.col("again") * F.col("part")).over(every))
    return t.select("source", "target_share", "max_repeats", "docs", "have", "demand", slope.alias("slope"))


def _running(docs: DataFrame) -> DataFrame:
    """docs with `before`: tokens of the source's documents that precede in hash order."""
    size = docs.groupBy("source").agg(F.greatest(F.ceil(F.count("*") / RANGE), F.lit(1)).alias("parts"))
    h = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    d = docs.withColumn("h", h).join(_few(size), "source").withColumn("part", F.floor(F.col("h") / F.lit(2.0**63) * F.col("parts")))
    sums = d.groupBy("source", "part").agg(F.sum("n_tokens").alias("s"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "part", F.coalesce(F.sum("s").over(ahead), F.lit(0)).alias("earlier"))
    mine = Window.partitionBy("source", "part").orderBy("h", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("within", F.coalesce(F.sum("n_tokens").over(mine), F.lit(0)))
    return d.join(sums, ["source", "part"]).select("doc_id", "source", "n_tokens", (F.col("earlier") + F.col("within")).alias("before"))


def position(u: Column, slope: Column) -> Column:
    """Training position in [0, 1] at which a source with this slope has used up the fraction u of its demand."""
    root = (slope - 1 + F.sqrt((1 - slope) * (1 - slope) + 4 * slope * u)) / (2 * slope)
    return F.when(F.abs(slope) < 1e-9, u).otherwise(F.least(F.greatest(root, F.lit(0.0)), F.lit(1.0)))


def chosen(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """Documents in the mixture: doc_id, source, n_tokens, repeats (1 to max_repeats) and the position of the first
    copy.  docs is (doc_id, source, n_tokens).  Ties in hash order go by id; a repeated id counts as a document."""
    # targets are one row per source of a hand-written list; what is grouped by their sources is as small
    listed = targets.select(label("source").alias("source")).distinct()
    docs = docs.join(_few(listed), "source", "left_semi")
    p = plan(docs, targets, total_tokens).select("source", "have", "demand", "slope", "max_repeats")
    d = _running(docs).join(_few(p), "source").filter("demand > 0")
    middle = F.col("before") + F.col("n_tokens") / 2
    # copy number c is in if the middle of the document, c whole passes on, lies within the demand
    copies = F.least(F.col("max_repeats").cast("long"), F.greatest(F.lit(0), F.ceil((F.col("demand") - middle) / F.col("have"))))
    first = position(F.least(middle / F.col("demand"), F.lit(1.0)), F.col("slope"))
    d = d.withColumn("repeats", copies.cast("int")).filter("repeats > 0")
    return d.select("doc_id", "source", "n_tokens", "repeats", first.alias("first_position"), middle.alias("_middle"), "have", "demand", "slope")


def ordered(picked: DataFrame) -> DataFrame:
    """Every copy (doc_id, source, n_tokens, copy from 1, position), range-sorted by position."""
    each = picked.select("*", F.explode(F.sequence(F.lit(1), "repeats")).alias("copy"))
    at = position(F.least((F.col("_middle") + (F.col("copy") - 1) * F.col("have")) / F.col("demand"), F.lit(1.0)), F.col("slope"))
    return each.select("doc_id", "source", "n_tokens", "copy", at.alias("position")).orderBy("position", "doc_id", "copy")


def shares(picked: DataFrame, targets: DataFrame, docs: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """One row per target and per used source: target_share, actual_share, tokens, docs, copies; have and unused, the tokens
    of all its documents and of those that were not chosen; binding: all copies it may give are used up, so that it sets
    the size of the mixture or falls short of its share.  docs is (doc_id, source, n_tokens)."""
    used = picked.groupBy("source").agg(F.sum(F.col("n_tokens").cast("long") * F.col("repeats")).alias("tokens"), F.sum("n_tokens").alias("once"), F.count("*").alias("docs"), F.sum("repeats").alias("copies"))
    planned = plan(docs, targets, total_tokens)
    binding = (F.col("demand") > 0) & (F.col("demand") >= F.col("have") * F.col("max_repeats") * (1 - 1e-9))
    t = planned.select("source", "target_share", F.col("have").cast("long").alias("have"), binding.alias("binding"))
    all_ = t.join(used, "source", "left").fillna(0, ["tokens", "once", "docs", "copies"])
    total = F.sum("tokens").over(Window.partitionBy())
    share = F.when(total > 0, F.col("tokens") / total).otherwise(0.0)
    return all_.select("source", "target_share", share.alias("actual_share"), "tokens", "docs", "copies", "have", (F.col("have") - F.col("once")).alias("unused"), "binding")


def mixture(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None, path: str | None = None) -> DataFrame:
    """`chosen` from raw documents (doc_id, text, source); tokens are counted once and kept in the shared folder."""
    return chosen(counted(docs, path), targets, total_tokens)


def counted(docs: DataFrame, path: str | None = None) -> DataFrame:
    """`sized`, kept in the shared folder."""
    return cut(sized(docs, path=path))
