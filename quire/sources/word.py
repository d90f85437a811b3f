"""Reading word-processor files in the zip format, with the standard library alone.

Each file is parsed where its bytes are; one that cannot be read gives one row with its error.
"""

from __future__ import annotations

import io
import os
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _style_names(z: zipfile.ZipFile) -> dict[str, str]:
    if "word/styles.xml" not in z.namelist():
        return {}
    root = ElementTree.fromstring(z.read("word/styles.xml"))
    return {s.get(f"{_W}styleId"): n.get(f"{_W}val", "") for s in root.iter(f"{_W}style") if (n := s.find(f"{_W}name")) is not None}


def heading_level(style: str) -> int:
    """0 for a style that is no heading; a heading without a number has level 1."""
    if "heading" not in style.lower() and "标题" not in style:
        return 0
    found = re.search(r"\d+", style)
    return int(found.group()) if found else 1


def has_image(node: ElementTree.Element) -> bool:
    return any(e.tag.rpartition("}")[2] in ("blip", "imagedata") for e in node.iter())


def table_text(table: ElementTree.Element) -> str:
    """Cells joined by ' | ', rows by line feeds, nested tables' rows too; empty rows are left out."""
    rows = []
    for tr in table.iter(f"{_W}tr"):
        cells = ["".join(tc.itertext()).strip() for tc in tr.findall(f"{_W}tc")]
        if any(cells):
            rows.append(" | ".join(cells))
    return "\n".join(rows)


def elements(data: bytes) -> Iterator[tuple[str, str, bool, bool, int]]:
    """(type, content, has_image, is_heading, heading_level) of a document's paragraphs and tables in order."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        styles = _style_names(z)
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
        for node in body if body is not None else ():
            if node.tag == f"{_W}p":
                text = "".join(t.text or "" for t in node.iter(f"{_W}t")).strip()
                ref = node.find(f"{_W}pPr/{_W}pStyle")
                style = ref.get(f"{_W}val", "") if ref is not None else ""
                level = heading_level(styles.get(style, style))
                image = has_image(node)
                if text or image:
                    yield "paragraph", text, image, level > 0, level
            elif node.tag == f"{_W}tbl" and (text := table_text(node)):
                yield "table", text, has_image(node), False, 0


def media(data: bytes) -> list[str]:
    """Names of the media files, in the order of the archive."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return [n for n in z.namelist() if n.startswith("word/media/") and not n.endswith("/")]


def files(spark: SparkSession, folder: str, pattern: str = "*.{docx,pdf,DOCX,PDF}") -> DataFrame:
    """(path, doc_name, suffix, content) of a folder's documents; the content is read only if it is used."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]+$", "")
    return f.select("path", T.safe_filename(name, name).alias("doc_name"), F.lower(F.regexp_extract("path", r"\.[^.]+$", 0)).alias("suffix"), "content")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Elements of every document in a folder: doc_name, path, elem_idx, elem_type, content, has_image, is_heading,
    heading_level, error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, path, data in zip(b["doc_name"], b["path"], b["content"]):
                try:
                    rows += [(doc, path, i, *e, None) for i, e in enumerate(elements(data))]
                except Exception as e:  # noqa: BLE001
                    rows.append((doc, path, None, None, None, None, None, None, repr(e)[:200]))
            yield pd.DataFrame(rows, columns=["doc_name", "path", "elem_idx", "elem_type", "content", "has_image", "is_heading", "heading_level", "error"]).astype({"elem_idx": "Int32", "heading_level": "Int32"})

    found = files(spark, folder, "*.docx").select("doc_name", "path", "content")
    return found.mapInPandas(run, "doc_name string, path string, elem_idx int, elem_type string, content string, has_image boolean, is_heading boolean, heading_level int, error string")


def images(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_name, image_no, media, original_filename) of the documents' media in archive order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, data in zip(b["doc_name"], b["content"]):
                try:
                    names = media(data)
                except Exception:  # noqa: BLE001  the reader of elements reports the file
                    names = []
                rows += [(doc, i, n, f"img_{i + 1:03d}_{os.path.basename(n)}") for i, n in enumerate(names)]
            yield pd.DataFrame(rows, columns=["doc_name", "image_no", "media", "original_filename"])

    found = files(spark, folder, "*.docx").select("doc_name", "content")
    return found.mapInPandas(run, "doc_name string, image_no int, media string, original_filename string")


def write_images(spark: SparkSession, folder: str, names: DataFrame, out: str) -> DataFrame:
    """Write media under their final names (doc_name, image_no, smart_filename) to out/<doc>/images, a folder that all
    executors share; (doc_name, smart_filename, bytes) of what was written."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, data, wanted in zip(b["doc_name"], b["content"], b["names"]):
                found = media(data)
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    for n in wanted:
                        if n["image_no"] < len(found):
                            at = os.path.join(out, doc, "images", n["smart_filename"])
                            os.makedirs(os.path.dirname(at), exist_ok=True)
                            content = z.read(found[n["image_no"]])
                            with open(at + ".part", "wb") as f:
                                f.write(content)
                            os.replace(at + ".part", at)
                            rows.append((doc, n["smart_filename"], len(content)))
            yield pd.DataFrame(rows, columns=["doc_name", "smart_filename", "bytes"])

    lists = names.filter(~F.col("smart_filename").contains("/")).groupBy("doc_name").agg(F.collect_list(F.struct("image_no", "smart_filename")).alias("names"))
    f = files(spark, folder, "*.docx").select("doc_name", "content").join(lists, "doc_name")
    return f.mapInPandas(run, "doc_name string, smart_filename string, bytes long")
