"""Sentence units of texts in many languages and scripts, in SQL expressions alone.

A working copy of the text, as many code points long, has every white space as a plain space or line feed and each
point that ends no sentence (in numbers, URLs, initials, abbreviations, ordinals) under a private-use placeholder.
Script-specific terminators then cut it, the pieces' lengths give positions, and the text between them is restored
from the original.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK, CUT = "", ""

# Abbreviations by what may follow their point.
#: Titles and joining words: a sentence goes on after them.
TITLES = (
    "dr|drs|mr|mrs|ms|mx|prof|sr|sra|srta|dra|hr|fr|st|eng|gen|rev|hon|capt|lt|sgt|dipl|mag|messrs|mme|mlle|"
    "vs|approx|cf|viz|ca|bzw|vgl|sog|bspw|ggf|evtl|inkl|zzgl|exkl|zb|resp|ej|esp|incl|डॉ|श्री|प्रो|कु|"
    r"e\.g|i\.e|a\.k\.a|e\. g|i\. e|z\.b|z\. b|d\.h|d\. h|u\.a|u\. a|o\.ä|o\. ä|i\.d\.r|i\. d\. r|p\.ej|u\.u|v\. a|v\.a|s\. o|s\. u|s\.o|s\.u|m\. e|ee"
)
#: Words that take a number: the point ends nothing before a number or a numeral.
NUMBERED = "no|nos|nr|nro|núm|num|fig|figs|sec|secs|abb|tab|kap|vol|ch|chap|pp|pág|págs|pag|art|arts|eq|ref|bd|cap|ed|para|app|jan|feb|mar|apr|jun|jul|aug|sep|sept|oct|okt|nov|dec|dez|ene|abr|ago|dic|pos|ziff|abs"
#: May close a sentence: the point ends it unless a small letter, a number or an opening bracket follows.
EITHER = "etc|usw|inc|ltd|co|corp|llc|bros|jr|s\\.a|a\\.m|p\\.m|a\\. m|p\\. m|ave|rd|blvd|dept|est|max|min|std|hrs|hr|sek|mio|mrd|tel|jan|feb|mar|apr|jun|jul|aug|sep|sept|oct|okt|nov|dec|dez|u\\.s|d\\.c|ph\\.d|m\\.a|b\\.a|ab|abt|geb|gest|str|ud|uds|vd|uu|al|ff|bc|ad"
MONTHS = "Januar|Jänner|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember"
BEFORE_ORDINAL = "am|im|der|die|das|dem|den|des|zum|zur|vom|bis|beim|ab|seit|jeder|jede|jedes|ihr|sein|unser"

_IDEO = r"⺀-⿟々-〇぀-ヿ㐀-䶿一-鿿豈-﫿가-힯"
_THAI = r"฀-๿"
_MARKS = r"!?。！？．｡।॥؟۔‼⁇⁈⁉…‥︒︕︖﹒﹖﹗."
_CLOSE = r"""”’»›)\]}）］｝」』】〉》〕〗｣"'＂＇"""
_COMMA = ",，、،;；:：؛"
_NOT_IN_WORD = r"(?<![\p{L}\p{M}\p{N}])"
_SPACES = "\t\x1f\xa0              　"
_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85  "

#: A point that ends no sentence.
_INNER_POINT = "".join(
    [
        r"\.(?:",
        # the next character carries on: a word, number, path; straight after an ideograph only a file ending does, and
        # between two names in ideographic text a new sentence begins
        rf"(?<![{_IDEO}]\.)(?!(?<=(?:[{_IDEO}][A-Z][a-z]{{1,24}}|[%‰°)）》”’」』])\.)[A-Z][a-z]+[{_IDEO}])(?=[\p{{IsLatin}}\p{{IsGreek}}\p{{IsCyrillic}}\p{{N}}_/\\@#%&=+*$~^|<`\-])",
        rf"|(?<=[{_IDEO}]\.)(?=[a-z][a-z0-9]{{0,4}}(?![A-Za-z0-9_\-])|[\p{{N}}_/\\@#%&=+*$~^|<`\-]|[A-Z]{{2,5}}\d?(?![A-Za-z\-]))",
        rf"|(?= ?[{_COMMA}])",
        rf"|(?<=[{_THAI}]\.)",
        rf"|(?<={_NOT_IN_WORD}(?i:{TITLES})\.)(?=\s*\S)",
        rf"|(?<={_NOT_IN_WORD}(?i:{NUMBERED})\.)(?=\s*(?:[\p{{N}}(]|[IVXLC]+\b|[A-Z]\b))",
        rf"|(?<={_NOT_IN_WORD}(?i:{EITHER})\.)(?=\s+[\p{{Ll}}\p{{N}}(&])",
        # initials; a small letter alone needs company
        rf"|(?<={_NOT_IN_WORD}[\p{{Lu}}\p{{Lt}}]\.)(?=\s*\S)",
        rf"|(?<={_NOT_IN_WORD}[\p{{Lo}}&&[^{_IDEO}{_THAI}]]\.)(?=\s*\S)",
        rf"|(?<={_NOT_IN_WORD}\p{{Ll}}\.)(?=\s*(?:\p{{Ll}}|\p{{N}}|\p{{L}}\.))",
        # ordinals
        rf"|(?<=\d\.)(?=\s+(?:{MONTHS})\b)",
        rf"|(?<={_NOT_IN_WORD}(?i:{BEFORE_ORDINAL})\s\d{{1,3}}\.)(?=\s+\p{{L}})",
        r")",
    ]
)
# A number of any depth begins a paragraph; a line inside one only a plain number (a wrapped line may begin with a version).
_LEADING_NUMBER = rf"(^ *|\n *\n *)((?:#+ *)?\d{{1,2}}(?:[.{MASK}]\d{{1,3}})*)\.(?=[ \p{{L}}])"
_LINE_NUMBER = rf"(?md)^( *(?:#+ *)?\d{{1,2}})\.(?=[ \p{{L}}])"
_URL_MARK = r"((?:https?|ftp)://[A-Za-z0-9\-._~:/#\[\]@$&'()*+,;=%]*|(?!^)\G[A-Za-z0-9\-._~:/#\[\]@$&'()*+,;=%]*)[?!](?=[A-Za-z0-9\-_~/#=%&])"
_CLOSERS = rf"(?:[{_CLOSE}]|[“‘«](?=[\s{_COMMA}{_MARKS}]|$))"
_END = rf"((?:[{_MARKS}]++{_CLOSERS}*+){{1,40}}+)(?! ?[{_COMMA}\[])(?!(?<=[{_CLOSE}“‘«])\s*(?:\p{{Ll}}|と))(?!(?<=(?:\.\.|…|‥))\s*\p{{Ll}})"


def working_copy(text: Column) -> Column:
    """The text with placeholders for points that end nothing and plain white space; equally long."""
    m = F.regexp_replace(text, "\r\n", " \n")
    m = F.translate(m, _SPACES + _BREAKS + CUT, " " * len(_SPACES) + "\n" * len(_BREAKS) + MASK)
    m = F.regexp_replace(m, _URL_MARK, f"$1{MASK}")
    m = F.regexp_replace(m, _LEADING_NUMBER, f"$1$2{MASK}")
    m = F.regexp_replace(m, _LINE_NUMBER, f"$1{MASK}")
    return F.regexp_replace(m, _INNER_POINT, MASK)


def pieces(text: Column) -> Column:
    """The working copy cut after each sentence and at each blank line; the pieces join to the whole copy."""
    m = F.regexp_replace(working_copy(text), _END, f"$1{CUT}")
    m = F.regexp_replace(m, rf"(?<=[{_THAI}])( +)(?=[{_THAI}])", f"{CUT}$1")
    m = F.regexp_replace(m, r"\n(?= *\n)", f"{CUT}\n")
    return F.split(m, CUT, -1)


#: Pieces summed in one go; keeps the cost of running totals down on very long texts.
_BLOCK = 512


def spans(p: Column) -> Column:
    """array<struct<start_pos int, end_pos int>> of the sentences in a text's pieces, in code points, end exclusive."""
    blank = " \n"

    def span(off: Column, x: Column) -> Column:
        lead = F.length(x) - F.length(F.ltrim(x, F.lit(blank)))
        whole = F.length(F.trim(x, F.lit(blank)))
        return F.struct((off + lead).cast("int").alias("start_pos"), (off + lead + whole).cast("int").alias("end_pos"))

    empty = F.expr("cast(array() as array<struct<start_pos:int,end_pos:int>>)")

    def block(xs: Column) -> Column:
        start = F.struct(F.lit(0).alias("off"), empty.alias("out"))
        add = lambda acc, x: F.struct(
            (acc["off"] + F.length(x)).alias("off"), F.concat(acc["out"], F.array(span(acc["off"], x))).alias("out")
        )
        return F.aggregate(xs, start, add)

    firsts = F.sequence(F.lit(0), F.greatest(F.size(p) - 1, F.lit(0)), F.lit(_BLOCK))
    blocks = F.transform(firsts, lambda i: block(F.slice(p, i + 1, F.lit(_BLOCK))))
    start = F.struct(F.lit(0).alias("off"), empty.alias("out"))
    shift = lambda off, s: F.struct((s["start_pos"] + off).alias("start_pos"), (s["end_pos"] + off).alias("end_pos"))
    joined = F.aggregate(
        blocks,
        start,
        lambda acc, b: F.struct(
            (acc["off"] + b["off"]).alias("off"), F.concat(acc["out"], F.transform(b["out"], lambda s: shift(acc["off"], s))).alias("out")
        ),
    )
    return F.filter(joined["out"], lambda s: s["start_pos"] < s["end_pos"])


def sentences(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """One row per sentence: the id, sentence_no from 0, start_pos, end_pos and the sentence itself.

    Null, empty and blank texts give nothing; a null id stays null; repeated rows each give their sentences.
    """
    # pieces come in a projection of their own, or each use of them would cut the text anew
    p = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col), F.col(text_col).alias("_text"), pieces(F.col(text_col)).alias("_p"))
    s = p.select(id_col, "_text", F.posexplode(spans(F.col("_p"))).alias("sentence_no", "_s"))
    at = s.select(id_col, "sentence_no", "_s.start_pos", "_s.end_pos", "_text")
    return at.withColumn("sentence", F.expr("substring(_text, start_pos + 1, end_pos - start_pos)")).drop("_text")
