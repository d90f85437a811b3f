"""Cutting oversized texts into overlapping pieces at natural boundaries.

A text starts as atomic segments between all its possible boundaries (paragraph, line, sentence, clause, word).  A
heap holds the adjacent pairs; the weakest boundary is merged away first, the smaller pair first among equals, as
long as the merged segment and the overlap before it fit the limit.  What is left are cuts at the strongest
boundaries that the limit allows.  Each piece then repeats the end of the one before it, from a sentence end, else a
word end, else the first whole character within `overlap` code points.  Limit and overlap hold exactly.
"""

from __future__ import annotations

import heapq
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

LIMIT, OVERLAP = 1000, 200

HARD, WORD, CLAUSE, SENTENCE, LINE, PARAGRAPH = range(6)
_BOUNDARY = re.compile(
    r"(?:(?P<s>[.!?।॥؟۔…][\"'”’»)\]]*(?=\s)|[。！？｡．…]+[”’」』）)》】]*)|(?P<c>[,;:،؛](?=\s)|[，；：、]))\s*|\s+"
)
_BREAK = re.compile("\r\n|[\n\r\x0b\x0c\x85  ]")


def _strength(m: re.Match) -> int:
    breaks = _BREAK.findall(m.group())
    if len(breaks) > 1 or "\u2029" in breaks:
        return PARAGRAPH
    return LINE if breaks else SENTENCE if m.group("s") else CLAUSE if m.group("c") else WORD


def _whole(text: str, at: int) -> bool:
    """Whether a cut at this position splits no character from its marks or joiners."""
    return at >= len(text) or not (unicodedata.combining(text[at]) or text[at] in "‍️" or text[at - 1] == "‍" or unicodedata.category(text[at]) in ("Mn", "Mc"))


def _safe(text: str, at: int, low: int) -> int:
    """The nearest position not after `at` that splits no character from its marks or joiners; `at` if none is near."""
    return next((p for p in range(at, max(low, at - 16), -1) if _whole(text, p)), at)


def cores(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> tuple[list[int], dict[int, int]]:
    """Starts of the segments that are left, and every boundary with its strength."""
    room, n = limit - overlap, len(text)
    strength = {m.end(): _strength(m) for m in _BOUNDARY.finditer(text) if m.end() < n}
    starts = [0]
    for b in [*strength, n]:
        a = starts[-1]
        while b - a > room:  # no boundary inside: cut hard
            a = _safe(text, a + room, a)
            starts.append(a)
            strength[a] = HARD
        if b < n:
            starts.append(b)
    starts = sorted(set(starts))
    m = len(starts)
    end = [*starts[1:], n]
    after, before, alive = list(range(1, m + 1)), list(range(-1, m - 1)), [True] * m
    heap = [(strength[starts[i + 1]], end[i + 1] - starts[i], i, end[i], end[i + 1]) for i in range(m - 1)]
    heapq.heapify(heap)
    while heap:
        _, _, i, middle, last = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= m or end[i] != middle or end[j] != last:
            continue
        if last - starts[i] > (room if starts[i] else limit):
            continue
        end[i], alive[j] = last, False
        k = after[i] = after[j]
        if k < m:
            before[k] = i
            heapq.heappush(heap, (strength[starts[k]], end[k] - starts[i], i, last, end[k]))
        if (k := before[i]) >= 0:
            heapq.heappush(heap, (strength[starts[i]], last - starts[k], k, end[k], last))
    return [starts[i] for i in range(m) if alive[i]], strength


def cut_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start, core_start, end) of the pieces of a text; the cores join to the whole text."""
    if not text:
        return []
    if len(text) <= limit:
        return [(0, 0, len(text))]
    begin, strength = cores(text, limit, overlap)
    known = sorted(strength)
    out, low = [], 0
    for k, a in enumerate(begin):
        start = a
        if k and overlap:
            least = max(begin[k - 1], a - overlap)
            while low < len(known) and known[low] < least:
                low += 1
            inside, i = [], low
            while i < len(known) and known[i] < a:
                inside.append(known[i])
                i += 1
            strong = [p for p in inside if strength[p] >= SENTENCE]
            word = [p for p in inside if strength[p] >= WORD]
            start = strong[0] if strong else word[0] if word else next((p for p in range(least, a) if _whole(text, p)), least)
        out.append((start, a, begin[k + 1] if k + 1 < len(begin) else len(text)))
    return out


_SPANS = ArrayType(
    StructType([StructField(n, IntegerType()) for n in ("start_pos", "core_start", "end_pos")])
)


def piece_spans(text: Column, limit: int = LIMIT, overlap: int = OVERLAP) -> Column:
    @F.arrow_udf(_SPANS)
    def run(column: pa.Array) -> pa.Array:
        rows = [
            None if t is None else [dict(zip(("start_pos", "core_start", "end_pos"), p)) for p in cut_text(t, limit, overlap)]
            for t in column.to_pylist()
        ]
        kind = pa.list_(pa.struct([(n, pa.int32()) for n in ("start_pos", "core_start", "end_pos")]))
        return pa.array(rows, kind)

    return run(text)


def split_oversized(items: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP, others: list[str] = ()) -> DataFrame:
    """Ordered pieces of every item: id (and `others`), piece_no from 0, start_pos, core_start, end_pos, piece.

    Positions are code points; [core_start, end_pos) of an item's pieces is its whole text, [start_pos, core_start)
    repeats the end of the piece before.  A text within the limit is one piece.  Null and empty texts give none;
    repeated rows each give their pieces.  Only oversized texts leave the JVM.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be smaller than limit")
    text, long = F.col(text_col), F.length(text_col) > limit
    keep = [F.col(c) for c in dict.fromkeys([id_col, *others])]
    spans = items.filter(F.length(text_col) > 0).select(*keep, text.alias("_text"), long.alias("_long"), piece_spans(F.when(long, text), limit, overlap).alias("_cut"))
    each = spans.select(*keep, "_text", F.posexplode(F.when(F.col("_long"), F.col("_cut")).otherwise(F.array(F.struct(F.lit(0).alias("start_pos"), F.lit(0).alias("core_start"), F.length("_text").alias("end_pos"))))).alias("piece_no", "_p"))
    return each.select(*keep, "piece_no", "_p.*", F.expr("substring(_text, _p.start_pos + 1, _p.end_pos - _p.start_pos)").alias("piece"))
