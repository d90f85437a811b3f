"""Linking the spellings of one person or organisation.

A name is brought to a form (order, case, marks, titles, legal forms, nicknames, abbreviations).  Equal forms are one.
Other forms meet in blocks of token suffixes of a minimum length.  Of a token's suffixes the shortest that few forms share
is enough, since the blocks of longer ones lie inside it.  If even the shortest is too common it is refined with halves of
the form's other tokens: a slip of the pen leaves one half as it was, so none is lost.  What is then still too common is
not discarded but compared block by block.  Pairs that meet are compared token by token by the ratio of their longest
common subsequence, and linked forms make up components.  An initial or a bare brand meets full forms by suffix and
initial letter, and joins a component only if it is the only one that it can mean.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from quire.operators.components import connected
from quire.plans.lineage import cut
from quire.plans.runs import whole_runs

#: Shortest suffix, in letters and in ideographs; forms in a block before it is refined; forms to a block of what is
#: too common then.
SUFFIX, SUFFIX_HAN, COMMON, BLOCK = 4, 2, 40, 300

# Words that carry no identity, and short forms.
TITLES = frozenset("mr mrs ms miss mx dr prof professor eng ing sir dame rev hon herr frau sr sra srta dra don dona mme mlle m".split()) - {"m"}
LEGAL = frozenset("ltd limited inc incorporated corp corporation co company llc llp plc gmbh ag kg sa srl bv nv oy ab pty group holding holdings the and hq".split())
NICKNAMES = {
    short: full
    for full, shorts in {
        "alexander": "alex sasha sandy", "amelia": "amy millie mellie", "andrew": "andy drew", "anthony": "tony", "barbara": "barb babs", "benjamin": "ben benny benji", "charles": "chuck chaz", "charlotte": "charlie lottie lotte char",
        "christopher": "chris", "clara": "clare", "daniel": "dan danny", "david": "dave davy", "dmitri": "dima mitya", "edith": "edie", "edward": "ed eddie ned", "elizabeth": "liz beth lizzie betty eliza betsy", "fabian": "fabe", "frederick": "fred freddie freddy fritz",
        "gabriel": "gabe", "gregory": "greg", "gustav": "gus", "hanna": "hannie", "helen": "nell nellie", "henrietta": "hettie etta henny", "henry": "hank harry", "isabella": "bella izzy isa bell", "james": "jim jimmy jamie", "john": "jack johnny", "jonas": "jon", "joseph": "joe joey", "judith": "judy jude",
        "katherine": "kate kathy katie kit kitty kat", "konrad": "kon", "lawrence": "larry laurie", "leon": "lee", "linda": "lindy", "magnus": "mags", "margaret": "maggie meg peggy marge", "matthew": "matt", "michael": "mike mickey mick", "muhammad": "mohammed mohammad mohamed muhammed", "nadia": "nadja", "nicholas": "nick nicky nico", "oliver": "ollie",
        "patricia": "pat patty trish tricia", "pavel": "pasha", "peter": "pete", "rafael": "rafa raf rafe", "rebecca": "becky becca", "richard": "rick dick richie rich", "robert": "bob bobby rob robbie", "samuel": "sam sammy", "silvia": "sylvie", "sophie": "soph", "stefan": "steff stef", "stephen": "steve", "susan": "sue susie", "theodore": "ted theo teddy",
        "thomas": "tom tommy", "tobias": "toby tobi", "ulrich": "uli ulli", "ursula": "ursel ulla", "viktor": "vic vik", "victor": "vic_v", "victoria": "vicky tori", "vincent": "vince vinny vinnie", "walter": "walt wally", "wanda": "wandy", "werner": "wern", "william": "will bill billy willy liam", "yusuf": "yusef", "yvonne": "yvie", "zachary": "zach zack",
    }.items()
    for short in shorts.split()
}
SHORT_WORDS = {
    "publ": "publishing", "pub": "publishing", "tech": "technologies", "technology": "technologies", "eng": "engineering", "engr": "engineering", "cons": "consulting", "consult": "consulting", "log": "logistics", "lab": "laboratories", "labs": "laboratories", "ins": "insurance", "instr": "instruments", "inst": "instruments",
    "fds": "foods", "svc": "services", "svcs": "services", "serv": "services", "mfg": "manufacturing", "intl": "international", "ind": "industries", "inds": "industries", "mgmt": "management", "sys": "systems", "sol": "solutions", "comm": "communications", "pharm": "pharmaceuticals", "fin": "financial", "trans": "transport",
}
TRADES = (
    "信息技术|环境工程|智能装备|精密仪器|文化传播|供应链管理|生物科技|新能源材料|新能源|新材料|网络科技|软件技术|电子商务|电子科技|科技发展|科技|技术|实业|贸易|建筑工程|工程|物流|医药|医疗器械|食品|餐饮管理|教育咨询|教育科技|教育|咨询|管理咨询|投资|投资管理|"
    "传媒|广告|机械|机械制造|制造|化工|纺织|服饰|房地产|地产|能源|环保|环保科技|汽车|电气|电器|光电|半导体|通信|数据|农业|旅游|酒店|保险|金融"
)
HAN_LEGAL = r"(?:股份有限公司|有限责任公司|有限公司|集团公司|集团|总公司|分公司|公司|股份)"
HAN_TITLES = "经理|老师|同学|先生|女士|小姐|总监|主任|主管|工程师|教授|博士|医生|律师|部长|组长|总|工"
DEPARTMENT = r"[一-鿿]{1,5}(?:组|部|科|处|室|中心|队)"

_HAN = re.compile(r"[㐀-䶿一-鿿]")
_FORM = StructType(
    [StructField("kind", StringType()), StructField("tokens", ArrayType(StringType())), StructField("rest", ArrayType(StringType())), StructField("city", StringType())]
)


def plain(name: str) -> str:
    t = unicodedata.normalize("NFKC", name)
    t = "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")
    return " ".join(unicodedata.normalize("NFC", t).casefold().split())


def form(name: str | None) -> tuple[str, list[str], list[str], str] | None:
    """(kind, tokens, rest, city) of a name: person has [given, surname] (or [initial, surname]) and middle initials
    as rest, org its words, han_org [brand] or [brand, trade], han_person the bare name.  Digits may be part of an
    organisation's words.  None: neither."""
    t = plain(name or "")
    if not t:
        return None
    return _han_form(t) if _HAN.search(t) else _latin_form(t)


def _han_form(t: str) -> tuple[str, list[str], list[str], str] | None:
    t = t.lstrip("@").strip()
    inside = re.findall(r"[(\[]([^)\]]*)[)\]]", t)
    t = re.sub(r"[(\[][^)\]]*[)\]]", "", t)
    t = re.sub(rf"^{DEPARTMENT}[\-/·:]", "", t.replace(" ", ""))
    t = re.sub(rf"[\-/·:]{DEPARTMENT}$", "", t)
    if not re.fullmatch(r"[㐀-䶿一-鿿·a-z0-9]+", t):
        return None
    bare = re.sub(rf"{HAN_LEGAL}+$", "", t)
    trade = re.search(rf"(?:{TRADES})$", bare)
    if bare != t or (trade and len(bare) > 4):
        brand = bare[: trade.start()] if trade and trade.start() >= 2 else bare
        rest = [trade.group()] if trade and trade.start() >= 2 else []
        return ("han_org", [brand, *rest], [], (inside or [""])[0]) if len(brand) >= 2 else None
    if re.search("[a-z0-9]", t):
        return None
    if len(t) > 3:
        t = re.sub(rf"(?<=..)(?:{HAN_TITLES})$", "", t)
    if len(t) in (2, 3):
        return "han_person", [t], [], ""
    return ("han_org", [t], [], "") if len(t) == 4 else None


def _latin_form(t: str) -> tuple[str, list[str], list[str], str] | None:
    t = re.sub(r"\([^)]*\)", " ", t).lstrip("@").strip()
    t = re.sub(r"\b(?:[a-z]\.){2,}", lambda m: m.group().replace(".", "") + " ", t)  # l.l.c., g.m.b.h.
    comma = re.fullmatch(r"\s*([^,]+?)\s*,\s*([^,]+?)\s*", t)
    legal_tail = comma and comma.group(2).replace(".", "") in LEGAL
    if comma and not legal_tail:
        t = f"{comma.group(2)} {comma.group(1)}"
    words = [w for w in re.split(r"[^\w']+", t.replace("_", " ")) if w]
    if not words or not all(re.fullmatch(r"[^\W_']+(?:'[^\W_]+)?", w) for w in words):
        return None
    numbered = any(c.isdigit() for w in words for c in w)
    while len(words) > 2 and words[0] in TITLES:
        words = words[1:]
    kept = [w for w in words if w not in LEGAL]
    if len(kept) >= 3 and not any(len(w) == 1 for w in kept) or (len(kept) < len(words) and len(kept) >= 1) or (numbered and kept):
        return "org", sorted(SHORT_WORDS.get(w, w) for w in kept), [], ""
    if len(words) == 3 and words[0] in TITLES:
        words = words[1:]
    if len(words) < 2:
        return None
    ends, middle = [words[0], words[-1]], words[1:-1]
    if len(ends[1]) == 1:
        ends.reverse()
    if len(ends[1]) == 1 or any(len(w) > 1 for w in middle):
        return None
    return "person", [NICKNAMES.get(ends[0], ends[0]), NICKNAMES.get(ends[1], ends[1]) if len(ends[0]) > 1 and ends[1] in NICKNAMES and ends[0] not in NICKNAMES else ends[1]], middle, ""


def formed(name: Column) -> Column:
    @F.arrow_udf(_FORM)
    def run(column: pa.Array) -> pa.Array:
        out = [form(x) for x in column.to_pylist()]
        rows = [None if f is None else dict(zip(("kind", "tokens", "rest", "city"), f)) for f in out]
        return pa.array(rows, pa.struct([("kind", pa.string()), ("tokens", pa.list_(pa.string())), ("rest", pa.list_(pa.string())), ("city", pa.string())]))

    return run(name)


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence; a machine word of columns at a time."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    v = all_ = (1 << len(a)) - 1
    for c in b:
        u = v & at.get(c, 0)
        v = (v + u | v - u) & all_
    return len(a) - v.bit_count()


def lcs_ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence over the sum of lengths."""
    if a == b:
        return 1.0
    return 2 * lcs(a, b) / (len(a) + len(b))


def alike(a: str, b: str) -> bool:
    """Whether two tokens can be one word with a slip of the pen; digits must be the same."""
    if a == b:
        return True
    n = max(len(a), len(b))
    if abs(len(a) - len(b)) > 1 or n < 3:
        return False
    if len(set(a) ^ set(b)) > 3 or any(c.isdigit() for c in a + b):
        return False
    return lcs_ratio(a, b) >= (0.82 if n >= 6 else 0.8 if n != 4 else 0.75)


def shortened(a: str, b: str) -> bool:
    """Whether the shorter token abbreviates the longer: its first letter, then letters in order."""
    a, b = sorted((a, b), key=len)
    if len(a) < 3 or len(a) > 0.6 * len(b) or a[0] != b[0] or a in SHORT_WORDS.values():
        return False
    rest = iter(b)
    return all(c in rest for c in a)


def same(ka: str, a: list[str], kb: str, b: list[str], fa: int, fb: int) -> bool:
    """Whether two forms mean the same; fa, fb: how many forms have the given name (persons)."""
    if ka != kb:
        # two words without a legal form may name a firm as well as a person, unless one is a given name
        person, org = (a, b) if ka == "person" else (b, a)
        return {ka, kb} == {"person", "org"} and len(org) == 2 and not FULL & {*person} and all(len(x) > 1 for x in person) and _same_words(sorted(person), org, 0)
    if ka == "person":
        if len(a[0]) == 1 or len(b[0]) == 1:
            return False
        if alike(a[1], b[1]) and a[0] == b[0]:
            return True
        if alike(a[1], b[1]) and alike(a[0], b[0]):
            # two given names that are both in common use are two persons
            return not (min(fa, fb) >= 3 and min(fa, fb) >= 0.1 * max(fa, fb)) and not (a[0] in FULL and b[0] in FULL)
        return alike(a[0], b[1]) and alike(a[1], b[0]) and (a[0] == b[1] or a[1] == b[0])
    if ka == "org":
        return len(a) == len(b) and _same_words(a, b, 2)
    if ka == "han_org":
        return len(a) == 2 == len(b) and a[1] == b[1] and (a[0] == b[0] or len(a[0]) == len(b[0]) >= 4 and lcs_ratio(a[0], b[0]) >= 0.9)
    # one ideograph makes another person unless the name is long
    return a == b or min(len(a[0]), len(b[0])) >= 4 and a[0][:2] == b[0][:2] and lcs_ratio(a[0], b[0]) >= 0.85


def _same_words(a: list[str], b: list[str], most: int) -> bool:
    """Whether the words pair up, at most so many of them only alike or shortened."""
    left, spent = list(b), 0
    for x in a:
        hit = next((y for y in left if y == x), None)
        if hit is None and (hit := next((y for y in left if alike(x, y) or shortened(x, y)), None)) is not None:
            spent += 1
        if hit is None:
            return False
        left.remove(hit)
    return spent <= most


FULL = frozenset(NICKNAMES.values()) | frozenset(
    "adele agnes alma basil bruno carla celia dario derek elsa emil felix flora gideon greta hugo ida igor ivan jana joan julia kasper klara laura lydia maria marta milan nils nina nora olga oscar otto paula petra quinn ralph rosa ruth tilda una vera xenia zeno zora anna emma eva dora ada".split()
)


def suffixes(token: str, han: bool) -> list[str]:
    """Suffixes that a token is met by, the shortest first; the whole of it if it is short, or holds digits, which must
    be the same."""
    least = SUFFIX_HAN if han else SUFFIX
    if any(c.isdigit() for c in token):
        return [token]
    return [token[i:] for i in range(len(token) - least, -1, -1)] or [token]


def block_keys(kind: str, tokens: list[str]) -> list[tuple[str, int, int]]:
    """(key, token, rank) of a form's suffixes, rank 0 for a token's shortest; persons and organisations in Latin script
    are in the same blocks."""
    group = {"person": "l", "org": "l", "han_org": "h", "han_person": "p"}[kind]
    numbers = [i for i, t in enumerate(tokens) if any(c.isdigit() for c in t)]  # those must agree, so they meet by them
    return [(f"{group}|{s}", i, r) for i in numbers or range(len(tokens)) for r, s in enumerate(suffixes(tokens[i], group != "l"))]


def halves(token: str) -> set[str]:
    """The starts and the ends by which two tokens with one slip of the pen still meet: a slip leaves the first or the
    last half, less the letters that may have changed places, as it was.  Tokens may differ by one in length, so both
    lengths count; digits must be the same."""
    if any(c.isdigit() for c in token):
        return {f"={token}"}
    n = {max(1, (size - 2) // 2) for size in (len(token), len(token) - 1)}
    return {x for k in n for x in (f"<{token[:k]}", f">{token[-k:]}")}


def refined_keys(key: str, tokens: list[str], at: int) -> list[str]:
    """A suffix key of token number `at` refined by the halves of the other tokens, of itself if there is no other."""
    others = [t for i, t in enumerate(tokens) if i != at] or [tokens[at]]
    others = [t for t in others if any(c.isdigit() for c in t)] or others
    return sorted({f"{key}|{e}" for t in others for e in halves(t)})


_KEYS = ArrayType(StructType([StructField("key", StringType()), StructField("token", IntegerType()), StructField("rank", IntegerType())]))


def keys(kind: Column, tokens: Column) -> Column:
    @F.arrow_udf(_KEYS)
    def run(k: pa.Array, t: pa.Array) -> pa.Array:
        found = [[dict(zip(("key", "token", "rank"), x)) for x in block_keys(*y)] for y in zip(k.to_pylist(), t.to_pylist())]
        return pa.array(found, pa.list_(pa.struct([("key", pa.string()), ("token", pa.int32()), ("rank", pa.int32())])))

    return run(kind, tokens)


def refined(key: Column, tokens: Column, at: Column) -> Column:
    @F.arrow_udf(ArrayType(StringType()))
    def run(k: pa.Array, t: pa.Array, i: pa.Array) -> pa.Array:
        return pa.array([refined_keys(*x) for x in zip(k.to_pylist(), t.to_pylist(), i.to_pylist())], pa.list_(pa.string()))

    return run(key, tokens, at)


def compared(ka: Column, ta: Column, na: Column, kb: Column, tb: Column, nb: Column) -> Column:
    """Whether two forms mean the same, from their kinds, tokens and numbers."""

    @F.arrow_udf(BooleanType())
    def run(*columns: pa.Array) -> pa.Array:
        return pa.array([same(k, x, q, y, m, n) for k, x, m, q, y, n in zip(*(c.to_pylist() for c in columns))], pa.bool_())

    return run(ka, ta, na, kb, tb, nb)


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forms of one cell that mean the same, those of one side with those of the other; side 2 is both."""
    for table, starts in whole_runs(batches, "cell"):
        rows = table.to_pylist()
        src, dst = [], []
        for s, e in zip(starts[:-1], starts[1:]):
            left, right = [r for r in rows[s:e] if r["side"] != 1], [r for r in rows[s:e] if r["side"] != 0]
            for x in left:
                for y in right:
                    if (x["form"] < y["form"] or x["side"] != 2) and same(x["kind"], x["tokens"], y["kind"], y["tokens"], x["n"], y["n"]):
                        src.append(x["form"])
                        dst.append(y["form"])
        yield pa.RecordBatch.from_arrays([pa.array(src, pa.string()), pa.array(dst, pa.string())], names=["src", "dst"])


def _by_blocks(wide: DataFrame) -> DataFrame:
    """Links (src, dst) inside keys that many forms share: each is cut into blocks, each pair of blocks is one cell."""
    parts = wide.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("parts"))
    own = wide.join(parts, "key").withColumn("mine", F.pmod(F.xxhash64("form"), "parts"))
    each = own.select("key", "form", "kind", "tokens", "n", "mine", F.explode(F.expr("sequence(0L, parts - 1)")).alias("other"))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    side = F.when(low == high, 2).when(F.col("mine") == low, 0).otherwise(1).cast("long")
    cells = each.select(F.xxhash64("key", low, high).alias("cell"), "form", "kind", "tokens", "n", side.alias("side"))
    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(_hits, "src string, dst string")


def _shared(keyed: DataFrame) -> DataFrame:
    """Rows of keys that several forms share, with their number."""
    return cut(keyed.join(keyed.groupBy("key").agg(F.count("*").alias("many")).filter("many > 1"), "key"))


def _pairs(few: DataFrame) -> DataFrame:
    """All pairs (src, dst, and kind, tokens and n of both) of the forms of keys that few share."""
    block = few.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("form", "kind", "tokens", "n"))).alias("f"))
    pair = block.select(F.explode(F.expr("flatten(transform(f, (x, i) -> transform(slice(f, i + 2, size(f)), y -> struct(x as a, y as b))))")).alias("p"))
    return pair.select(F.col("p.a.form").alias("src"), F.col("p.b.form").alias("dst"), *[F.col(f"p.{x}.{c}").alias(f"{c}_{x}") for x in "ab" for c in ("kind", "tokens", "n")])


def links(forms: DataFrame) -> DataFrame:
    """(src, dst) of the forms (form, kind, tokens, n) that meet in a block and mean the same."""
    held = ["form", "kind", "tokens", "n"]
    keyed = _shared(forms.select(*held, F.explode(keys(F.col("kind"), F.col("tokens"))).alias("k")).select(*held, "k.*"))
    mine = Window.partitionBy("form", "token").orderBy("rank")
    few = keyed.filter(F.col("many") <= COMMON).withColumn("first", F.row_number().over(mine)).filter("first = 1")
    wide = keyed.filter(F.col("many") > COMMON).filter("rank = 0")
    again = _shared(wide.select(*held, F.explode(refined(F.col("key"), F.col("tokens"), F.col("token"))).alias("key")).distinct())
    pair = _pairs(few).unionByName(_pairs(again.filter(F.col("many") <= COMMON))).dropDuplicates(["src", "dst"])
    met = pair.filter(compared(*[F.col(f"{c}_{x}") for x in "ab" for c in ("kind", "tokens", "n")])).select("src", "dst")
    return cut(met.unionByName(_by_blocks(again.filter(F.col("many") > COMMON))))


def _abbreviated(whole: DataFrame) -> DataFrame:
    """(form, cluster) of the initials and bare brands in whole (form, kind, tokens, cluster): the component of the full
    forms that they can mean, if it is the only one, else their own.  An exact surname goes before a similar one."""
    initial = (F.col("kind") == "person") & (F.length(F.col("tokens")[0]) == 1)
    bare = (F.col("kind") == "han_org") & (F.size("tokens") == 1)
    short = initial | bare
    name = F.when(F.col("kind") == "person", F.col("tokens")[1]).otherwise(F.col("tokens")[0])
    letter = F.when(F.col("kind") == "person", F.substring(F.col("tokens")[0], 1, 1)).otherwise(F.lit(""))
    least = F.when(F.col("kind") == "person", F.greatest(F.length("name") - SUFFIX, F.lit(0))).otherwise(F.lit(0))
    met = whole.filter(F.col("kind").isin("person", "han_org")).select("form", "kind", "cluster", short.alias("short"), name.alias("name"), letter.alias("letter"))
    met = met.withColumn("suffix", F.explode(F.transform(F.sequence(F.lit(0), least), lambda i: F.substr(F.col("name"), i + 1))))
    key = ["kind", "letter", "suffix"]
    a = met.filter("short").select(*key, "form", "name")
    b = met.filter("not short").groupBy(*key, F.col("name").alias("full")).agg(F.min("cluster").alias("one"), F.max("cluster").alias("two"))
    pair = a.join(b, key).groupBy("form", "name", "full").agg(F.min("one").alias("one"), F.max("two").alias("two"))
    pair = pair.withColumn("exact", F.col("name") == F.col("full")).filter(F.col("exact") | _slip(F.col("name"), F.col("full")))
    per = pair.groupBy("form", "exact").agg(F.min("one").alias("one"), F.max("two").alias("two"))
    best = per.groupBy("form").agg(F.max_by(F.struct("one", "two"), "exact").alias("o")).filter("o.one = o.two").select("form", F.col("o.one").alias("only"))
    return whole.filter(short).join(best, "form", "left").select("form", F.coalesce("only", "cluster").alias("cluster"))


def _slip(a: Column, b: Column) -> Column:
    @F.arrow_udf(BooleanType())
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([len(p) >= 5 and alike(p, q) for p, q in zip(x.to_pylist(), y.to_pylist())], pa.bool_())

    return run(a, b)


def linked(names: DataFrame, name_col: str = "entity_name") -> DataFrame:
    """(name, cluster) of every distinct spelling of a person or organisation; cluster is a form of the component.

    Null and blank names, and those that have the form of neither, take no part; types are not looked at.
    """
    each = names.select(F.col(name_col).alias("name")).filter("name is not null").distinct()
    f = each.select("name", formed(F.col("name")).alias("f")).filter("f is not null").select("name", "f.*")
    f = cut(f)
    cities = f.filter("city <> ''").groupBy(F.col("city").alias("prefix")).agg(F.count("*").alias("n")).filter("n >= 2").select("prefix")
    brand = F.col("tokens")[0]
    f = f.withColumn("head", F.when((F.col("kind") == "han_org") & (F.length(brand) >= 5), F.substring(brand, 1, 2)))
    f = f.join(cities.withColumn("head", F.col("prefix")), "head", "left")
    cutoff = F.concat(F.array(F.expr("substring(tokens[0], 3)")), F.slice("tokens", 2, F.greatest(F.size("tokens") - 1, F.lit(0))))
    f = f.withColumn("tokens", F.when(F.col("prefix").isNotNull(), cutoff).otherwise(F.col("tokens")))
    f = cut(f.select("name", "kind", "tokens", F.concat_ws("|", "kind", F.concat_ws(" ", "tokens")).alias("form")))
    forms = f.select("form", "kind", "tokens").dropDuplicates(["form"])
    used = forms.filter("kind = 'person'").groupBy(F.col("tokens")[0].alias("given")).agg(F.count("*").alias("n"))
    forms = cut(forms.join(used, (F.col("kind") == "person") & (F.col("tokens")[0] == F.col("given")), "left").select("form", "kind", "tokens", F.coalesce("n", F.lit(0)).alias("n")))
    comp = connected(links(forms))
    whole = cut(forms.join(comp.withColumnRenamed("node", "form"), "form", "left").select("form", "kind", "tokens", F.coalesce("component", "form").alias("cluster")))
    tied = _abbreviated(whole)
    final = whole.join(tied.select("form"), "form", "left_anti").select("form", "cluster").unionByName(tied)
    return f.select("name", "form").join(final, "form").select("name", "cluster")


def same_pairs(names: DataFrame, name_col: str = "entity_name") -> DataFrame:
    """Each pair (name_a < name_b by bytes) of different spellings of one person or organisation."""
    n = cut(linked(names, name_col))
    more = n.groupBy("cluster").count().filter("count > 1").select("cluster")
    n = n.join(more, "cluster", "left_semi")
    pair = n.select("cluster", F.col("name").alias("name_a")).join(n.select("cluster", F.col("name").alias("name_b")), "cluster")
    return pair.filter("name_a < name_b").select("name_a", "name_b")
