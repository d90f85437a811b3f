"""Putting documents together from elements and pages, and looking around images."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.core import tidying
from quire.functions import text as T
from quire.operators import naming
from quire.plans.lineage import cut
from quire.plans.order import beside, in_blocks, numbered

#: Elements looked at before and after an image, and code points kept of its context.
BACK, AHEAD, CONTEXT = 8, 5, 600
#: Blocks of the neighbouring pages, code points of their text, and the distance they start from.
PAGE_BLOCKS, PAGE_TEXT, PAGE_DISTANCE = 5, 400, 3
#: Parts that are joined to one text at most.
VOLUME = 1000


def elements(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, elem_idx, content, has_image, is_heading, heading_level): a text's blocks between blank lines in order.

    An element with an image reference has has_image; a `#` line or a short one without closing mark is a heading.
    Null texts have no elements, an empty text has one empty element.
    """
    parts = docs.select(key, F.posexplode(F.split(F.col(text), "\n\n")).alias("elem_idx", "content"))
    head = F.col("content").rlike(r"^#+ ") | (F.col("content").rlike(r"^[^。！？.!?\n]{1,30}$") & ~F.col("content").contains("图片："))
    level = F.greatest(F.length(F.regexp_extract("content", "^(#+)", 1)), F.lit(1))
    return parts.select(key, "elem_idx", "content", F.col("content").contains("图片：./images/").alias("has_image"), head.alias("is_heading"), F.when(head, level).otherwise(0).alias("heading_level"))


def joined_in_order(parts: DataFrame, key: str | list[str], order: str, content: str, glue: str = "\n\n", out: str = "full_text") -> DataFrame:
    """One text per key from its parts in order; null parts are left out.  For keys of bounded size; see `volumes`."""
    keys = [key] if isinstance(key, str) else key
    return parts.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, content))), lambda s: s[content]), glue).alias(out))


def volumes(parts: DataFrame, key: str, order: list[str], content: str, most: int = VOLUME, glue: str = "\n\n", out: str = "full_text") -> DataFrame:
    """(key, volume, text): each key's parts in order, `most` to a text, so that no key is gathered in one task."""
    p = in_blocks(parts, key, order, most, "volume").withColumn("_at", F.struct(*order))
    return joined_in_order(p, [key, "volume"], "_at", content, glue, out)


def positions(parts: DataFrame, key: str, order: str, content: str, glue: int = 2) -> DataFrame:
    """Each part with the offset at which it starts in the joined text."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("position", F.coalesce(F.sum(F.length(content) + glue).over(w), F.lit(0)).cast("long"))


def own_text(content: Column) -> Column:
    """An image element's text beside its references; empty if it has no other."""
    return T.strip(F.regexp_replace(content, "(?U)" + T.IMAGE_REFERENCE, ""))


def surroundings(elems: DataFrame, key: str, back: int = BACK, ahead: int = AHEAD, most: int = CONTEXT) -> DataFrame:
    """For each element with an image: the non-empty elements before and after it with their distance (0 nearest),
    and both sides joined and cut to `most` code points.

    The image element's own text comes first on the side after, if it has any.  The side before is put in reading order
    and keeps its end, so what stays is what is nearest the image.
    """
    w = Window.partitionBy(key).orderBy("elem_idx")
    seg = F.when(F.col("content") != "", F.struct(F.col("content").alias("text"), "is_heading", "heading_level"))
    around = elems.withColumn("b", F.collect_list(seg).over(w.rowsBetween(-back, -1))).withColumn("a", F.collect_list(seg).over(w.rowsBetween(1, ahead)))
    around = around.filter("has_image").withColumn("own", own_text(F.col("content")))
    first = F.struct(F.col("own").alias("text"), "is_heading", "heading_level")
    around = around.withColumn("a", F.when(F.col("own") != "", F.concat(F.array(first), "a")).otherwise(F.col("a")))

    def told(segments: Column) -> Column:
        return F.transform(segments, lambda s, i: F.struct(s["text"].alias("text"), i.alias("distance"), s["is_heading"].alias("is_heading"), s["heading_level"].alias("heading_level")))

    before = F.right(F.array_join(F.transform("b", lambda s: s["text"]), " "), F.lit(most))
    after = F.left(F.array_join(F.transform("a", lambda s: s["text"]), " "), F.lit(most))
    return around.select(key, "elem_idx", told(F.reverse("b")).alias("segments_before"), told(F.col("a")).alias("segments_after"), before.alias("context_before"), after.alias("context_after"))


def prompt_context(segments_before: Column, segments_after: Column) -> Column:
    """The context part of an image-naming prompt, each segment with the label of its distance."""
    line = lambda s: F.concat(T.distance_label(s["distance"], s["is_heading"], s["heading_level"]), F.lit(" "), s["text"])
    side = lambda title, segs: F.when(F.size(segs) > 0, F.concat(F.lit(title + "\n"), F.array_join(F.transform(segs, line), "\n")))
    return F.concat_ws("\n\n", side("【图片前的内容】", segments_before), side("【图片后的内容】", segments_after))


def page_text(text: Column, images: Column) -> Column:
    """A page's text with placeholders for its images in the middle paragraph gap; before all text on a page without
    a blank line."""
    paras = F.split(text, "\n\n")
    marks = F.transform(images, lambda i: F.concat(F.lit("[图片: images/"), i, F.lit("]")))
    middle = (F.size(paras) / 2).cast("int")
    whole = F.concat(F.slice(paras, F.lit(1), middle), marks, F.slice(paras, middle + 1, F.size(paras)))
    return F.when(F.size(images) > 0, F.array_join(whole, "\n\n")).otherwise(text)


def renamed_placeholders(text: Column, old: Column, new: Column) -> Column:
    """Each placeholder of an old image name as the final reference of its new name, one after the other."""
    pairs = F.arrays_zip(old.alias("o"), new.alias("n"))
    swap = lambda acc, p: F.replace(acc, F.concat(F.lit("[图片: images/"), p["o"], F.lit("]")), F.concat(F.lit("图片：./images/"), p["n"]))
    return F.aggregate(pairs, text, swap)


def page_contexts(pages: DataFrame, key: str = "doc_name") -> DataFrame:
    """Context of the images of a page (key, page_num, text, images, text_blocks): segments of the page before, of
    both halves of its own page and of the page after, and the joined strings.

    Blocks 1.2 times the document's mean size are headings, 1.5 times of level 1.  Blocks without text are no segments.
    Distances fall to 0 towards the image and rise behind it, and go on rising from PAGE_DISTANCE more on the page
    after; blocks of the page before have PAGE_DISTANCE.
    """
    sizes = F.filter(F.transform("text_blocks", lambda b: b["font_size"]), lambda s: s > 0)
    total = F.aggregate(sizes, F.lit(0.0), lambda s, x: s + x)
    mean = pages.groupBy(F.col(key).alias("_doc")).agg(F.coalesce(F.sum(total) / F.nullif(F.sum(F.size(sizes)), F.lit(0)), F.lit(12.0)).alias("mean_size"))
    blocks = F.col("text_blocks")
    last = F.when(F.size(blocks) > PAGE_BLOCKS, F.slice(blocks, -PAGE_BLOCKS, PAGE_BLOCKS)).otherwise(blocks)
    # what a neighbour can need is small; blocks of a page without images are needed nowhere else
    edge = F.struct(F.left("text", F.lit(PAGE_TEXT)).alias("head"), F.right("text", F.lit(PAGE_TEXT)).alias("tail"), F.slice(blocks, 1, PAGE_BLOCKS).alias("first"), last.alias("last"))
    slim = pages.select(key, "page_num", F.size("images").alias("_images"), F.when(F.size("images") > 0, blocks).alias("text_blocks"), edge.alias("_edge"))
    p = beside(slim, key, ["page_num"], F.col("_edge"), "page_before", "page_after").drop("_edge").filter("_images > 0")
    p = p.join(mean, F.col(key).eqNullSafe(F.col("_doc")))

    def segs(bs: Column, distance: Callable[[Column], Column]) -> Column:
        def seg(b: Column, i: Column) -> Column:
            head = b["font_size"] > 1.2 * F.col("mean_size")
            level = F.when(b["font_size"] > 1.5 * F.col("mean_size"), 1).when(head, 2).otherwise(0)
            return F.struct(b["text"].alias("text"), distance(i).cast("int").alias("distance"), head.alias("is_heading"), level.alias("heading_level"))

        return F.transform(full(bs), seg)

    full = lambda bs: F.filter(bs, lambda b: b["text"] != "")
    half = (F.size("text_blocks") / 2).cast("int")
    first, second = F.slice("text_blocks", F.lit(1), half), F.slice("text_blocks", half + 1, F.size("text_blocks"))
    none = F.expr("cast(array() as array<struct<text:string,font_size:double>>)")
    prev, after = F.coalesce("page_before.last", none), F.coalesce("page_after.first", none)
    before = F.concat(segs(prev, lambda i: F.lit(PAGE_DISTANCE)), segs(first, lambda i: F.greatest(half - 1 - i, F.lit(0))))
    behind = F.concat(segs(second, lambda i: i), segs(after, lambda i: F.size(full(second)) + PAGE_DISTANCE + i))
    text = lambda bs: F.array_join(F.transform(bs, lambda b: b["text"]), " ")
    cb = F.right(F.concat_ws(" ", F.col("page_before.tail"), text(first)), F.lit(CONTEXT))
    ca = F.left(F.concat_ws(" ", text(second), F.col("page_after.head")), F.lit(CONTEXT))
    return p.select(key, "page_num", "mean_size", before.alias("segments_before"), behind.alias("segments_after"), F.trim(cb).alias("context_before"), F.trim(ca).alias("context_after"))


def line_blocks(lines: Column) -> Column:
    """Text blocks of a page from its lines of spans (text, font_size): the spans' texts joined, and the largest size."""
    one = lambda spans: F.struct(F.array_join(F.transform(spans, lambda s: s["text"]), "").alias("text"), F.array_max(F.transform(spans, lambda s: s["font_size"])).alias("font_size"))
    return F.transform(lines, one)


def titles(elems: DataFrame, key: str) -> DataFrame:
    """A document's title: its first heading, else its first element that is not empty."""
    t = T.strip("content")
    full = elems.withColumn("_t", t).filter("_t <> ''")
    return full.groupBy(key).agg(F.coalesce(F.min_by("_t", F.when(F.col("is_heading"), F.col("elem_idx"))), F.min_by("_t", "elem_idx")).alias("title"))


def paired_by_place(left: DataFrame, right: DataFrame, key: str, left_order: str, right_order: str) -> DataFrame:
    """The i-th row of one side with the i-th of the other within a key; what is left over on a side is dropped."""
    a = numbered(left, key, [left_order], "place")
    b = numbered(right, key, [right_order], "place")
    return a.join(b, [key, "place"])


def assembled(elems: DataFrame, media: DataFrame, load: Callable | None = None, length: int = tidying.NAME_LENGTH, back: int = BACK, ahead: int = AHEAD, most: int = CONTEXT, key: str = "doc_name") -> tuple[DataFrame, DataFrame]:
    """A document's text with its images named, and the index of the images, from elements (as word.read gives them) and
    media files (key, image_no, media, original_filename).

    The i-th element with an image has the i-th media file; what is left over on a side is no image.  The texts are
    (key, text), parts joined by blank lines, an image's reference after the element's own text; the index is (key,
    image_no, media, filename, original_filename, context_before, context_after), names by the client of `load` or by
    rule, with the image's number.
    """
    e = elems.filter(F.col("elem_idx").isNotNull())
    at = surroundings(e, key, back, ahead, most)
    pair = paired_by_place(at, media.select(key, "image_no", "media", "original_filename"), key, "elem_idx", "image_no")
    pair = pair.withColumn("context", prompt_context(F.col("segments_before"), F.col("segments_after")))
    pair = naming.named(pair.select(key, "elem_idx", "image_no", "media", "original_filename", "context", "context_before", "context_after"), load, length)
    ext = F.regexp_extract("media", r"\.[^./]+$", 0)
    index = cut(pair.select(key, "elem_idx", "image_no", "media", F.concat("name", F.lit("_"), F.format_string("%03d", F.col("image_no") + 1), ext).alias("filename"), "original_filename", "context_before", "context_after"))
    mark = index.select(key, "elem_idx", F.concat(F.lit("图片：./images/"), "filename").alias("_mark"))
    parts = e.join(mark, [key, "elem_idx"], "left").withColumn("_own", F.nullif(F.when(F.col("has_image"), own_text(F.col("content"))).otherwise(F.col("content")), F.lit("")))
    parts = parts.select(key, "elem_idx", F.nullif(F.concat_ws("\n\n", "_own", "_mark"), F.lit("")).alias("content"))
    return joined_in_order(parts, key, "elem_idx", "content", out="text"), index.drop("elem_idx")
