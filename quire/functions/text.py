"""Column expressions over text; all stay in the JVM unless their name says udf."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from quire.core import splitting, tidying

# Characters that a file name may not hold, half-width and full-width, and the image reference.
_UNSAFE = r"[\\/:*?\"<>|\s\x1c-\x1f#%&+()\[\]{}]"
_UNSAFE_WIDE = r"[（）【】｛｝＃％＆＋　]"
IMAGE_REFERENCE = r"图片：\./images/([^\s\x1c-\x1f]+)"
# Address forms, the document type and the export format that each stands for.
ADDRESSES = (("wiki", "wiki", "docx"), ("docx", "docx", "docx"), ("docs?", "doc", "docx"), ("sheets?", "sheet", "xlsx"), ("(?:base|bitable)", "bitable", "xlsx"))
#: Types that can be exported, with the file format.
EXPORTS = {"doc": "docx", "docx": "docx"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(_col(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def blank(c: Column | str) -> Column:
    """Whether a text is null or holds nothing but white space."""
    return F.coalesce(~_col(c).rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(True))


def safe_filename(name: Column | str, fallback: Column | str) -> Column:
    """A name that is legal as a file and in a URL; the fallback where nothing of it is left."""
    name, fallback = _col(name), _col(fallback)
    s = F.when(F.coalesce(name, F.lit("")) == "", fallback).otherwise(name)
    s = F.regexp_replace(F.regexp_replace(s, "(?U)" + _UNSAFE, "_"), _UNSAFE_WIDE, "_")
    s = F.regexp_replace(F.regexp_replace(s, "_+", "_"), r"^[._ ]+|[._ ]+$", "")
    return F.when(s == "", fallback).otherwise(s)


def address_parts(url: Column | str, host: str = r"[\w.\-]+") -> Column:
    """struct<token, doc_type, ext> of a document address, null for any other; the first form that fits decides."""
    url, found = _col(url), None
    for path, kind, ext in reversed(ADDRESSES):
        pattern = rf"{host}/{path}/([A-Za-z0-9_-]+)"
        hit = F.struct(F.regexp_extract(url, pattern, 1).alias("token"), F.lit(kind).alias("doc_type"), F.lit(ext).alias("ext"))
        found = F.when(url.rlike(pattern), hit) if found is None else F.when(url.rlike(pattern), hit).otherwise(found)
    return found


def reader_of(kind: Column | str) -> Column:
    """What reads a file of this format or suffix, in lower case; why it is skipped where nothing does."""
    kind = F.regexp_replace(_col(kind), r"^\.", "")
    return F.when(kind.isin("word", "docx"), "word").when(kind == "pdf", "pdf").when(kind == "doc", "skip: convert first").otherwise("skip: unsupported")


def chunk_id(content: Column | str, index: Column | str) -> Column:
    """12 hexadecimal digits from the first 100 code points and the index."""
    return F.substring(F.md5(F.concat(F.left(_col(content), F.lit(100)), _col(index).cast("string"))), 1, 12)


def image_references(text: Column | str) -> Column:
    return F.regexp_extract_all(_col(text), F.lit("(?U)" + IMAGE_REFERENCE), F.lit(1))


def first_part(c: Column | str) -> Column:
    """What precedes the first separator of a joined list of ids; '' for null."""
    return F.coalesce(F.split_part(_col(c), F.lit("<SEP>"), F.lit(1)), F.lit(""))


def weight_or_one(c: Column | str) -> Column:
    """Null, zero and not-a-number weights count as 1."""
    c = _col(c)
    return F.when(c.isNull() | F.isnan(c) | (c == 0), F.lit(1.0)).otherwise(c)


def page_image_name(page: Column, image: Column, ext: Column) -> Column:
    return F.format_string("page_%04d_img_%03d.%s", page, image, ext)


def entity_text(name: Column, description: Column) -> Column:
    """What an entity is embedded by: its name, with the description if there is one."""
    return F.when(F.coalesce(description, F.lit("")) == "", name).otherwise(F.concat(name, F.lit(": "), description))


def distance_label(distance: Column, is_heading: Column, level: Column) -> Column:
    """The label of a context segment in an image-naming prompt."""
    near = F.concat(F.lit("【距离"), distance.cast("string"), F.lit("段】"))
    far = F.concat(F.lit("【较远"), distance.cast("string"), F.lit("段】"))
    head = F.concat(F.lit("【标题"), level.cast("string"), F.lit("级】"))
    return F.when(is_heading, head).when(distance == 0, "【紧邻】").when(distance <= 2, near).otherwise(far)


def images_json(images: Column) -> Column:
    """A list of image structs as JSON; [] for an empty or null list."""
    return F.when(F.coalesce(F.size(images), F.lit(0)) > 0, F.to_json(images)).otherwise("[]")


def split_udf(text: Column | str, size: int = splitting.SIZE, overlap: int = splitting.OVERLAP) -> Column:
    """Chunks of a text by recursive splitting, in Arrow batches.  Texts under the size limit that need no cut stay
    in the JVM if the caller filters them first (see operators.chunks)."""

    @F.arrow_udf(ArrayType(StringType()))
    def run(column: pa.Array) -> pa.Array:
        return pa.array([splitting.split(t, size, overlap) for t in column.to_pylist()], pa.list_(pa.string()))

    return run(_col(text))


def without_repeats_udf(text: Column | str) -> Column:
    @F.arrow_udf(StringType())
    def run(column: pa.Array) -> pa.Array:
        return pa.array([tidying.without_repeats(t) for t in column.to_pylist()], pa.string())

    return run(_col(text))


def image_name(before: Column, after: Column, length: int = tidying.NAME_LENGTH) -> Column:
    """A name for an image from the text around it: a window from three characters before a keyword, where it is no
    longer than `length`; else the end of the text before, else the start of the text after, without white space."""
    told = lambda c: F.coalesce(c, F.lit(""))
    near = lambda c: F.regexp_replace(told(c), r"(?U)[\s\x1c-\x1f]+", "")
    words = F.regexp_replace(F.concat(told(before), told(after)), "[^一-龥a-zA-Z0-9]", "")
    windows = F.transform(F.array(*[F.instr(words, k) for k in tidying.KEYWORDS]), lambda at: F.when(at > 0, F.substring(words, F.greatest(at - 3, F.lit(1)), length + F.least(at - 1, F.lit(3)))))
    by_word = F.get(F.filter(windows, lambda w: F.length(w).between(1, length)), 0)
    ends = [F.nullif(F.right(near(before), F.lit(length)), F.lit("")), F.nullif(F.left(near(after), F.lit(length)), F.lit(""))]
    return F.when(words == "", tidying.NO_NAME).otherwise(F.coalesce(by_word, *ends, F.lit(tidying.NO_NAME)))


def title_name(title: Column | str, name: Column | str) -> Column:
    """The file name a document gets from its title; its own name where it has no title."""
    title, name = strip(title), _col(name)
    return F.when(F.coalesce(title, F.lit("")) == "", name).otherwise(safe_filename(title, name))


def size_udf(text: Column | str, load: Callable[[], Callable[[str], int]]) -> Column:
    """Size of a text by any counter, such as a tokenizer's; 0 for null.  `load` makes it once in each batch."""

    @F.arrow_udf(LongType())
    def run(column: pa.Array) -> pa.Array:
        count = load()
        return pa.array([count(t) if t else 0 for t in column.to_pylist()], pa.int64())

    return run(_col(text))
