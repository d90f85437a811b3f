"""Field lists that spreadsheets carry in their first rows."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def fields(rows: DataFrame, key: str, names: str, descriptions: str, types: str) -> DataFrame:
    """(key, field_index, name, description, data_type): columns with a blank name are left out and keep the others'
    index; a missing description is empty, a missing type `string`."""
    z = rows.select(key, F.posexplode(F.arrays_zip(F.col(names).alias("n"), F.col(descriptions).alias("d"), F.col(types).alias("t"))).alias("field_index", "f"))
    z = z.select(key, "field_index", F.trim(F.col("f.n")).alias("name"), F.coalesce(F.trim(F.col("f.d")), F.lit("")).alias("description"), F.trim(F.col("f.t")).alias("t"))
    return z.filter("name <> ''").select(key, "field_index", "name", "description", F.coalesce(F.nullif("t", F.lit("")), F.lit("string")).alias("data_type"))


def per_file(sheets: DataFrame) -> DataFrame:
    """(path, found, extracted, success, error) of each workbook from its sheets (path, sheet, names, error): those there
    are, those with fields, and whether there is any of the latter."""
    has = F.coalesce(F.size("names") > 0, F.lit(False))
    return sheets.groupBy("path").agg(F.count("sheet").alias("found"), F.count_if(has).alias("extracted"), F.bool_or(has).alias("success"), F.max("error").alias("error"))


def _column(reference: str) -> int:
    n = 0
    for c in reference:
        if c.isalpha():
            n = n * 26 + ord(c.upper()) - 64
    return n - 1


def first_rows(data: bytes, rows: int = 3) -> Iterator[tuple[str, list[list[str]]]]:
    """(sheet name, its first rows as texts) of a workbook in the zip format."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{{{_NS['m']}}}sheet"):
            target = links[sheet.get(_REL)].lstrip("/")
            path = target if target.startswith("xl/") else f"xl/{target}"
            out = [[] for _ in range(rows)]
            for row in ElementTree.fromstring(z.read(path)).iter(f"{{{_NS['m']}}}row"):
                r = int(row.get("r", "1")) - 1
                if r >= rows:
                    break
                for c in row.findall("m:c", _NS):
                    at = _column(c.get("r", "A"))
                    value = c.findtext("m:v", "", _NS)
                    if c.get("t") == "s" and value:
                        value = shared[int(value)]
                    elif c.get("t") == "inlineStr":
                        value = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
                    out[r] += [""] * (at + 1 - len(out[r]))
                    out[r][at] = value
            yield sheet.get("name"), out


def read(spark: SparkSession, folder: str, pattern: str = "*.xlsx", name_row: int = 0, description_row: int = 1, type_row: int = 2) -> DataFrame:
    """(path, sheet, names, descriptions, types, error) of every sheet under a folder, from the rows of these numbers; a
    file that cannot be read gives one row with its error, a sheet that ends before the last of the rows one without
    names (see per_file)."""
    at = (name_row, description_row, type_row)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                try:
                    for name, r in first_rows(content, max(at) + 1):
                        rows.append((path, name, *((r[i] for i in at) if r[max(at)] else (None, None, None)), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((path, None, None, None, None, repr(e)[:200]))
            yield pd.DataFrame(rows, columns=["path", "sheet", "names", "descriptions", "types", "error"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content")
    return files.mapInPandas(run, "path string, sheet string, names array<string>, descriptions array<string>, types array<string>, error string")
