"""Records that hold template residue, filler, an error page or a script notice in place of content.

Lines are normalised and counted by host.  A line that recurs over a host's documents is boilerplate and is subtracted,
and so are headings and navigation; a record is excluded if what remains has no content of its own and holds error,
filler or script evidence, or if any sentence outside code that remains holds an unfilled placeholder which it does not
explain.  A phrase that only takes up a small part of its sentence is a mention, which is content.

Error pages recur by nature, and so do the lines of a template, so recurrence alone does not tell boilerplate from
evidence.  Two counts do: a recurrent line of evidence is subtracted if most documents that hold it have other content
(a footer that asks to sign in), and a line with a placeholder if it stands in most documents of its host (the frame of
the site, which says nothing of the record).
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable
from re import _constants, _parser

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from quire.plans.lineage import cut

#: A line is boilerplate if it is in this share of its host's documents, and in so many at least: a line of a host of
#: nine documents cannot be told from a quotation.  From FRAME on it belongs to the frame of the site.
SHARE, LEAST, FRAME = 0.001, 10, 0.5
#: A recurrent line of evidence is boilerplate if this share of the documents that hold it have content besides.
BESIDE = 0.5
#: Ids or lines up to which a set of them may be broadcast (8 bytes each).
SMALL = 1_000_000
#: Share of a sentence's letters that evidence must cover.
COVER = 0.6

# Evidence phrases, by what they tell.  What to look for first is derived from them (KEYWORDS).
_SCRIPT = (
    r"(?:to (?:continue|view this page|proceed)[, ]+)?(?:please )?(?:enable|activate|allow|turn on) (?:java ?script|scripts?|scripting|cookies)(?: and (?:cookies|scripts|reload))?(?: in your (?:browser|settings))?(?: to [a-z ]{3,40})?",
    r"java ?script (?:is|has been|must be|needs to be) (?:disabled|required|not enabled|turned off|switched off|enabled|blocked)[a-z ]{0,30}",
    r"(?:this|the) (?:app|application|site|website|page)(?: [a-z]+)? (?:requires|needs) (?:java ?script|scripts)(?: to be enabled)?[a-z ]{0,20}",
    r"you need to (?:enable|turn on|allow) (?:java ?script|scripts)[a-z ]{0,40}",
    r"your browser (?:does not|doesn't) support (?:java ?script|scripts|scripting)(?:,? or it has been (?:switched|turned) off)?",
    r"checking your browser[a-z ]{0,30}", r"cookies and scripts must be allowed", r"some parts of this site (?:will|may) not work", r"turn (?:it|them) on and (?:reload|refresh)[a-z ]{0,14}",
    r"请?(?:先)?(?:在(?:设置|浏览器)中)?(?:启用|开启|打开|允许)(?:浏览器的?|您的浏览器)? ?(?:java ?script|脚本|cookie)s?[^。，,；]{0,14}(?:[，,]?[^。，,；]{0,8}(?:刷新|访问|继续|重试))?",
    r"(?:本|此|该)(?:页面?|网站|应用)(?:需要|要求|必须)(?:启用|开启|打开|允许) ?(?:java ?script|脚本)[^。，；]{0,14}",
    r"您?的?浏览器(?:不支持|已禁用|禁用了|未启用) ?(?:java ?script|脚本)[，,]?[^。；]{0,16}", r"检测到(?:您的浏览器)?(?:java ?script|脚本)(?:已被|被|已)禁用[^。；]{0,24}", r"正在检查您的浏览器[^。；]{0,24}",
    r"bitte aktivieren sie (?:java ?script|skripte)[^.;]{0,50}", r"(?:diese|die) (?:seite|anwendung) (?:benötigt|erfordert) (?:java ?script|skripte)[^.;]{0,30}", r"(?:java ?script|skripte) (?:ist|sind) (?:deaktiviert|erforderlich)[^.;]{0,30}",
    r"(?:active|habilite|activa) (?:java ?script|los scripts)[^.;]{0,50}", r"(?:esta|la) (?:página|aplicación) (?:requiere|necesita) (?:java ?script|scripts)[^.;]{0,30}",
    r"(?:この|本)?ページを(?:表示|利用)するには ?(?:java ?script|スクリプト)を有効にしてください", r"(?:java ?script|スクリプト)を有効にし[^。]{0,14}", r"(?:java ?script|スクリプト)が無効[^。]{0,20}",
    r"(?:कृपया )?[^।.]{0,24}(?:java ?script|जावास्क्रिप्ट|स्क्रिप्ट)[^।.]{0,12}(?:सक्षम|चालू) क[^।.]{0,14}", r"(?:يرجى|الرجاء)? ?(?:تفعيل|تمكين) (?:java ?script|جافا ?سكريبت|البرامج النصية|النصوص البرمجية)[^.،]{0,40}", r"(?:กรุณา|โปรด)เปิด(?:ใช้งาน)? ?(?:java ?script|จาวาสคริปต์|สคริปต์)[^.]{0,40}",
)
_ERROR = (
    r"(?:error:? |http |status )?[45]\d\d:? ?(?:-|–)? ?(?:bad gateway|gateway time-?out|forbidden|(?:page )?not found|internal server error|service (?:temporarily )?unavailable|unauthorized|bad request|too many requests|gone|method not allowed)",
    r"error \d{3}:?(?: (?:the )?page[a-z ]{0,40})?", r"(?:access|permission|request) (?:is |was )?denied", r"you (?:do not|don't) have (?:permission|access)[a-z ]{0,40}", r"(?:your )?(?:session|link|login) (?:has )?(?:expired|timed out)", r"please (?:sign|log) in(?: again)?",
    r"(?:the |this )?(?:requested )?page (?:could not be|was not|cannot be|not) found", r"(?:the )?page you (?:asked for|requested|are looking for|were looking for)[a-z' ]{0,40}", r"this (?:document|page|file|link) (?:has (?:been )?|is )(?:deleted|moved|removed|expired|no longer available)(?: or (?:moved|deleted))?",
    r"(?:sorry,? )?something went wrong(?: on our (?:side|end))?", r"(?:please )?try again (?:later|in [a-z0-9 ]{1,20})", r"too many requests", r"slow down and retry[a-z ]{0,20}", r"we (?:can't|cannot|could not|couldn't) (?:seem to )?find (?:that|this|the) page", r"(?:oops|whoops|sorry)[!,.]?",
    r"traceback \(most recent call last\):?(?: ?\w+)?", r"(?:request|trace|incident|error) id:? ?[0-9a-f\-]{6,}", r"(?:an )?(?:unexpected|internal|unknown|server) (?:server )?error(?: has)?(?: occurred)?", r"(?:failed to load|loading failed|export failed|the file (?:could not|cannot) be (?:rendered|opened|displayed))[a-z :]{0,40}", r"service (?:is )?(?:temporarily )?unavailable",
    r"(?:系统|服务器?|网络|程序)(?:内部)?(?:错误|异常|繁忙|开小差了?|出错了?)[^。；]{0,16}", r"[（(]?错误码?[:：] ?\w+[）)]?", r"(?:该|此|您访问的)?页面(?:不存在|走丢了|找不到|无法访问|已(?:被)?(?:删除|移动|下线)[^。；]{0,8})", r"(?:很)?(?:抱歉|对不起)[，,]?(?:您访问的页面[^。；]{0,8})?", r"您访问的页面[^。；]{0,10}",
    r"网关(?:超时|错误)[，,]?(?:请刷新(?:页面)?)?", r"请刷新(?:页面)?(?:重试|后重试)?", r"请?稍后(?:再试|重试)", r"(?:加载|导出|渲染|打开|下载)失败[，,:：]?(?:点击重试|文件无法渲染|请[^。；]{0,8}|文件[^。；]{0,8})?", r"点击重试", r"(?:该|此)?(?:文档|文件|链接|内容)(?:已被?|已经)(?:删除|移动|失效|过期|下架)(?:或(?:移动|删除))?", r"您?(?:没有|无)权限?(?:访问|查看|打开)[^。，；]{0,10}(?:[，,]请联系管理员)?", r"请联系管理员",
    r"(?:登录|会话|链接)(?:状态)?(?:已|已经)(?:过期|失效|超时)[，,]?(?:请重新登录)?", r"请(?:重新|先)登录", r"(?:访问|请求)(?:被拒绝|过于频繁|太频繁)[^。；]{0,12}", r"(?:ошибка|erreur) \d{3}",
    r"(?:die )?seite (?:wurde )?nicht gefunden", r"zugriff verweigert", r"bitte melden sie sich (?:erneut|wieder)? ?an", r"(?:ihre )?(?:sitzung|anmeldung) ist abgelaufen", r"ein (?:interner |unerwarteter )?fehler ist aufgetreten", r"bitte versuchen sie es (?:später )?(?:erneut|noch einmal)",
    r"página no encontrada", r"(?:no tiene|usted no tiene) permiso para [a-záéíóú ]{3,40}", r"acceso denegado", r"(?:su |la )?sesión (?:ha )?(?:expirado|caducado)", r"(?:se ha producido|ha ocurrido) un error[a-z ]{0,20}", r"(?:inténtelo|intente) (?:de nuevo|más tarde)[a-z áé]{0,16}",
    r"(?:お探しの)?ページ(?:は|が)見つかりません(?:でした)?", r"アクセス(?:が)?(?:拒否|できません|権限)[^。]{0,14}", r"(?:セッション|ログイン)の?(?:有効期限|期限)?が?切れ[^。]{0,10}", r"エラーが発生しました", r"(?:もう一度|再度)(?:ログイン|お試し)[^。]{0,10}",
    r"ไม่พบหน้า[^ ]{0,30}", r"คุณไม่มีสิทธิ์[^ ]{0,40}", r"เกิดข้อผิดพลาด[^ ]{0,30}", r"(?:यह )?पृष्ठ (?:नहीं मिला|उपलब्ध नहीं)[^।.]{0,14}", r"आपको [^।.]{0,24}अनुमति नहीं[^।.]{0,8}", r"(?:الصفحة غير موجودة|لم يتم العثور على الصفحة|تم رفض الوصول|ليس لديك (?:إذن|صلاحية)[^.،]{0,30}|انتهت صلاحية الجلسة|حدث خطأ[^.،]{0,24})",
)
_FILLER = (
    r"(?:请?(?:在此|此处|点击此处|单击此处)(?:处)?(?:输入|添加|插入|编辑)(?:文本|文字|标题|内容|正文)|(?:测试){2,}|([一-鿿]{2,6})\1+)+",
    r"(?:正文内容|(?:这里是|此处为)?示例(?:文字|段落|内容)|占位(?:文字|内容|符)?|测试(?:文字|内容)|内容内容|文字文字|此处省略|待编辑|敬请期待)+",
    r"(?:asdf|qwer|zxcv|qwerty)(?:[ ,]+(?:asdf|qwer|zxcv|qwerty))*", r"content coming soon", r"click (?:here )?to (?:add|edit|insert|enter|type)(?: an?| the| your| some)? (?:title|subtitle|heading|text|content|name|description)", r"(?:your|insert|add) (?:text|content) (?:goes )?here", r"(?:sample|dummy|placeholder|test|filler) (?:text|paragraph|content)(?: (?:here|only))?", r"(?:blah[ ,]*){2,}", r"(?:test[ ,]+){2,}test", r"text to be added", r"to be (?:written|completed|announced)", r"coming soon",
    r"(?:ダミーテキスト|サンプルテキスト|ここに(?:文章|テキスト)が入ります)+", r"(?:platzhaltertext|beispieltext|blindtext)", r"(?:texto de (?:ejemplo|relleno|muestra))",
)
_LOREM = (
    "lorem|ipsum|dolor|sit|amet|consectetur|consectetuer|adipiscing|adipisicing|elit|sed|eiusmod|tempor|incididunt|labore|dolore|magna|aliqua|enim|minim|veniam|quis|nostrud|exercitation|ullamco|laboris|nisi|"
    "aliquip|commodo|consequat|duis|aute|irure|reprehenderit|voluptate|velit|esse|cillum|fugiat|nulla|pariatur|excepteur|sint|occaecat|cupidatat|proident|sunt|culpa|officia|deserunt|mollit|laborum|"
    "perspiciatis|unde|omnis|iste|natus|error|voluptatem|accusantium|doloremque|laudantium|totam|aperiam|eaque|ipsa|quae|inventore|veritatis|quasi|architecto|beatae|vitae|dicta|explicabo|nemo|ipsam|quia|voluptas|aspernatur|odit|fugit|"
    "consequuntur|magni|dolores|ratione|sequi|nesciunt|neque|porro|quisquam|dolorem|adipisci|numquam|eius|modi|tempora|incidunt|magnam|aliquam|quaerat|nostrum|exercitationem|corporis|suscipit|laboriosam|aliquid|commodi|consequatur|"
    "cursus|lectus|posuere|semper|porta|praesent|gravida|vestibulum|pellentesque|curabitur|suspendisse|vivamus|mauris|donec|etiam|integer|aenean|phasellus|morbi|nunc|nullam|tellus|augue|"
    "tincidunt|faucibus|ultrices|viverra|turpis|egestas|malesuada|habitant|senectus|netus"
)
#: Function words of languages in use; a sentence without any is no sentence of theirs.
_LIVING = "the|a|an|is|are|was|were|be|to|of|and|or|on|for|with|by|from|this|that|it|we|you|not|before|after|der|die|das|und|ist|ein|eine|nicht|mit|von|zu|el|la|los|las|un|una|y|de|del|que|en|es|con|para|por"
_NAME = r"[A-Za-z][A-Za-z0-9_.\- ]{0,40}"
_TAG = "a|b|i|p|u|br|hr|div|span|table|tr|td|th|ul|ol|li|img|h[1-6]|em|strong|code|pre|html|head|body|script|style|link|meta|form|input|button|label|nav|section|article|footer|header|main|sup|sub|small|center|font|title|svg|path"
#: No alternative begins otherwise; tried only there.
_PLACEHOLDER = r"(?=[{$<%\[«@#_&【（(〈《X:：])(?:" + "|".join(
    (
        rf"\{{\{{\s*{_NAME}\s*\}}\}}", rf"\$\{{\s*{_NAME}\s*\}}", rf"\{{%\s*{_NAME}\s*%\}}", rf"<%=?\s*{_NAME}\s*%>", r"%\([A-Za-z_]\w*\)[sdSD]", rf"\[\[\s*{_NAME}\s*\]\]", rf"\[:\s*{_NAME}\s*:\]", rf"«\s*{_NAME}\s*»", r"\$\$[A-Za-z]\w{2,}\$\$",
        r"@@[A-Za-z]\w{2,}@@", r"#[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)*#", r"(?<!\w)__[A-Za-z][A-Za-z0-9]*(?:_[A-Za-z0-9]+)*__(?!\w)", r"(?<![\w{}$])\{[A-Za-z_]{3,40}\}(?!\})",
        rf"<(?!/)(?!(?i:{_TAG})\b)[A-Za-z][A-Za-z_]{{2,30}}(?: [A-Za-z_]{{2,20}}){{0,3}}>", r"(?i:&lt;)[A-Za-z_][A-Za-z_ ]{2,40}(?i:&gt;)", r"\[\s*(?i:your|insert|enter|add|fill in|todo|tbd|tba|xxx)\b[^\]\n]{0,60}\]", r"\[(?:Client |Company |Customer |Project )?(?:Name|Date|Title|Address|Company|Customer|Owner|Version|Email|Phone)\]",
        r"[\[【（(<〈《][^\]】）)>〉》\n]{0,12}(?:待补充|待填写?|待定|待完善)[\]】）)>〉》]", r"[\[【（(<〈《](?:请|此处|在此)(?:处)?(?:填写|填入|输入|插入|补充)[^\]】）)>〉》\n]{0,16}[\]】）)>〉》]", r"XX[^\sX]{1,12}XX", r"_{3,}\s*[（(][^）)\n]{1,16}[）)]\s*_{3,}", r"[:：]\s*_{4,}",
    )
) + ")"
_EXPLAINED = r"(?i)写入|替换|渲染|变量|占位符|模板语法|语法|命令|格式为|字段名|replac|render|variable|placeholder|syntax|command|\btemplate|escap|interpolat|logger|printf|for example|e\.g\.|例如|比如|ersetz|platzhalter|reemplaz|marcador|変数|置換|プレースホルダ"
_CODE = r"```[\s\S]*?```|~~~[\s\S]*?~~~|`[^`\n]+`|(?m)^(?:    |\t)[^\n]*$"
_BAR = r"search|sign in|log in|login|sign up|register|help(?: cent(?:er|re))?|docs|contact(?: us)?|about(?: us)?|products|pricing|account|settings|blog|support"
_NAVIGATION = "|".join(
    (
        r"(?:©|\(c\)|copyright)\s*(?:\d{4}\s*)?[\p{L}\d.\-]{1,24}(?: (?:docs|documentation|inc\.?|ltd\.?|文档中心|帮助中心))?", rf"\b(?:home|start)(?:\s*[|>»/]\s*(?:{_BAR}))+", r"(?:首页|主页)(?:\s*[|>»/]\s*[一-鿿]{1,6})*", r"返回(?:上一页|首页|上页)", r"联系我们", r"帮助中心",
        r"back to (?:the )?(?:previous page|home(?: ?page)?|top)", r"\bcontact us\b", r"\bhelp cent(?:er|re)\b", r"\bcode\s*=\s*\d+", r"\bref\.? [a-z]{1,5}-?\d+", r"\[[\w\-]+/\d[\d.]*\]", r"(?:request|trace|incident) id:? ?[0-9a-f\-]{6,}", r"图片：\S+",
    )
)
_UNIT_END = r"([。！？!?।؟…]+[”」』\"'»)）]*|\.(?=\s|$))"


#: Strings that a pattern is expanded to at most, before it is cut into parts.
_EXPANDED = 128
#: Stands for a run of Han characters that comes twice in a row.
_TWICE = "\1"


def _better(a: set[str] | None, b: set[str] | None) -> set[str] | None:
    """Of two sets of which a match holds one member each, the one with the longer shortest member."""
    sets = [s for s in (a, b) if s and "" not in s]
    return max(sets, key=lambda s: (min(map(len, s)), -len(s)), default=None)


def _of(kind: object, arg) -> tuple[set[str] | None, set[str] | None]:  # noqa: ANN001
    """Of a part of a parsed pattern: all that it matches, if that is little, and a set of which each match holds one."""
    c = _constants
    if kind is c.LITERAL:
        return {chr(arg)}, {chr(arg)}
    if kind is c.IN and all(k is c.LITERAL for k, _ in arg) and len(arg) <= 4:
        return {chr(x) for _, x in arg}, {chr(x) for _, x in arg}
    if kind is c.AT:
        return {""}, None
    if kind is c.GROUPREF:
        return None, {_TWICE}
    if kind is c.SUBPATTERN:
        return _sequence(arg[-1])
    if kind is c.BRANCH:
        parts = [_sequence(x) for x in arg[1]]
        every, held = [e for e, _ in parts], [h for _, h in parts]
        return None if None in every else set().union(*every), None if None in held else set().union(*held)
    if kind is c.MAX_REPEAT and arg[:2] == (0, 1):
        every, _ = _sequence(arg[2])
        return every and every | {""}, None
    return None, None


def _sequence(items: Iterable) -> tuple[set[str] | None, set[str] | None]:
    whole, run, best = True, {""}, None

    def end() -> None:
        nonlocal whole, run, best
        whole, run, best = False, {""}, _better(best, run)

    def add(every: set[str] | None, held: set[str] | None) -> None:
        nonlocal run, best
        best = _better(best, held)
        if every is None or len(every) * len(run) > _EXPANDED:
            end()
        if every is not None and len(every) <= _EXPANDED:
            run = {a + b for a in run for b in every}

    for kind, arg in items:
        if kind is _constants.GROUPREF or kind is _constants.MAX_REPEAT and list(arg[2])[0][0] is _constants.GROUPREF:
            return None, {_TWICE}
        if kind is _constants.MAX_REPEAT and arg[0]:
            for _ in range(min(arg[0], 2)):
                add(*_sequence(arg[2]))
            if arg[1] != arg[0] or arg[0] > 2:  # between the first and the last time there may be more
                end()
                add(*_sequence(arg[2]))
        else:
            add(*_of(kind, arg))
    return run if whole else None, _better(best, run)


def keywords(pattern: str) -> set[str] | None:
    """Strings of which every match of a pattern holds one, or None if there is no such set."""
    return _sequence(_parser.parse(pattern))[1]


KEYWORDS = frozenset().union(*(keywords(p) for p in (*_SCRIPT, *_ERROR, *_FILLER)))
#: What navigation begins with, and a form of it that is found wherever it is.
_NAVIGATION_STARTS = ("©", "(c)", "copyright", "home", "start", "首页", "主页", "返回", "联系我们", "帮助中心", "back to ", "contact us", "help cent", "code", "ref", "[", "request id", "trace id", "incident id", "图片：")
_NAVIGATION_LIKE = re.compile(r"©|\(c\)|copyright|(?:home|start)\s*[|>»/]|首页|主页|返回|联系我们|帮助中心|back to |contact us|help cent|code\s*=|ref\.? [a-z]|\[[\w\-]+/\d|request id|trace id|incident id|图片：")
_PHRASE, _LATIN, _LINK = range(3)


def _repeats(texts: list[str | None]) -> np.ndarray:
    """Whether two to six Han characters come twice in a row, for each text."""
    codes = np.frombuffer("\n".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([0, *(len(t or "") + 1 for t in texts[:-1])])
    hit = np.zeros(len(codes) + 1, bool)
    han = (codes >= 0x4E00) & (codes <= 0x9FFF)
    for k in range(2, 7):
        same = (codes[:-k] == codes[k:]) & han[:-k]
        for _ in range(k - 1):
            same = same[:-1] & same[1:]
        hit[: len(same)] |= same
    return np.logical_or.reduceat(hit, starts)


@functools.cache
def _scanner() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    kinds = ((_LATIN, _LOREM.split("|")), (_LINK, _NAVIGATION_STARTS), (_PHRASE, KEYWORDS - {_TWICE}))
    for kind, words in kinds:
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def _held(text: str) -> bool:
    """Whether a text holds a keyword or two words of _LOREM.  Navigation is taken out later, and what it parts may be
    a keyword then; where it touches what is before it, the answer is yes."""
    latin = 0
    in_word = lambda i: 0 <= i < len(text) and text[i].isascii() and (text[i].isalnum() or text[i] == "_")
    for end, (kind, n) in _scanner().iter(text):
        start = end + 1 - n
        if kind == _PHRASE:
            return True
        if kind == _LATIN:
            latin += not in_word(start - 1) and not in_word(end + 1)
            if latin > 1:
                return True
        elif start and not text[start - 1].isspace() and _NAVIGATION_LIKE.match(text, start):
            return True
    return False


def possible(text: Column) -> Column:
    """Whether a lower-case text, or a part of it, can be evidence: false only if no pattern matches anywhere and fewer
    than two words are from _LOREM.  One pass over an automaton that is built once in each worker."""

    @F.arrow_udf(BooleanType())
    def run(column: pa.Array) -> pa.Array:
        texts = column.to_pylist()
        twice = _repeats(texts) if texts else ()
        return pa.array([t is not None and (bool(r) or _held(t)) for t, r in zip(texts, twice)], pa.bool_())

    return run(text)


def plain(text: Column) -> Column:
    """Lower-case, with odd white space and zero-width characters made plain; line feeds stay."""
    spaces = "   -‍  　﻿"
    return F.lower(F.regexp_replace(text, rf"[ \t{spaces}]{{2,}}|[\t{spaces}]", " "))


def units(text: Column) -> Column:
    """Sentences and lines of a text, trimmed, without blank ones."""
    cut = F.split(F.regexp_replace(text, _UNIT_END, "$1\n"), "[\r\n]+")
    return F.filter(F.transform(cut, lambda x: F.trim(x)), lambda x: x != "")


def letters(x: Column) -> Column:
    return F.length(F.regexp_replace(x, r"[^\p{L}\p{M}]", ""))


def normal_line(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"[^\p{L}\p{M}]+", " "))


def unfilled(line: Column) -> Column:
    """Whether some sentence of a line without code holds a placeholder that it does not explain."""
    return F.exists(units(line), lambda u: u.rlike(_PLACEHOLDER) & ~u.rlike(_EXPLAINED))


def without_code(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, _CODE, " "), "[   ]+", " ")


def evidence(unit: Column, may: Column) -> Column:
    """Whether error, filler or script phrases make up most of a lower-case unit without navigation; may: as possible()
    tells."""
    rest = F.regexp_replace(unit, "|".join((*_SCRIPT, *_ERROR, *_FILLER)), "")
    words = F.size(F.regexp_extract_all(unit, F.lit(r"\p{L}+"), F.lit(0)))
    latin = F.regexp_extract_all(unit, F.lit(rf"\b({_LOREM})\b"), F.lit(1))
    # generators mix made-up words in, so a fifth is enough if it is varied
    kinds = F.size(F.array_distinct(latin))
    varied = (kinds >= 3) | (kinds == 2) & ~unit.rlike(rf"\b(?:{_LIVING})\b")
    lorem = (words >= 4) & ((F.size(latin) >= 0.5 * words) | (F.size(latin) >= 0.2 * words) & varied)
    phrases = (letters(unit) > 0) & (letters(rest) <= (1 - COVER) * letters(unit))
    return F.when(may, phrases | lorem).otherwise(False)


def line_key(host: Column, line: Column) -> Column:
    return F.xxhash64(host, normal_line(line))


def _few(keys: DataFrame) -> DataFrame:
    """A table of keys, to be broadcast if a count shows that it is small."""
    return F.broadcast(keys) if keys.limit(SMALL + 1).count() <= SMALL else keys


def residue(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", url_col: str = "source_url", share: float = SHARE, least: int = LEAST, frame: float = FRAME
) -> DataFrame:
    """Ids of the records that are residue, each once.

    A line is boilerplate of its host from `share` of its documents and `least` documents on, and part of its frame from
    `frame` on.  Null, empty and blank texts are none, and a null id never comes out.  A null or unreadable URL counts
    as one host.
    """
    d = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc"),
        F.col(text_col).alias("text"),
        F.coalesce(F.lower(F.regexp_extract(url_col, r"^[a-zA-Z][\w+.\-]*://([^/:?#]+)", 1)), F.lit("")).alias("host"),
    )
    t = d.select("doc", "host", plain(F.col("text")).alias("text"))
    hashed = F.transform(F.split(F.col("text"), "[\r\n]+"), lambda x: line_key(F.col("host"), x))
    lines = t.select("host", F.explode_outer(F.array_distinct(hashed)).alias("line"))
    seen = lines.groupBy("line").agg(F.count("*").alias("n"), F.first("host").alias("host"))
    size = t.groupBy("host").agg(F.count("*").alias("docs"))
    common = seen.filter(F.col("n") >= least).join(size, "host").filter(F.col("n") >= share * F.col("docs"))
    common = cut(common.select("line", (F.col("n") >= frame * F.col("docs")).alias("frame")))
    # placeholders in lines that are not the site's frame
    held = d.filter(F.col("text").rlike(_PLACEHOLDER)).select("doc", "host", F.explode(F.split(without_code(F.col("text")), "[\r\n]+")).alias("l"))
    held = held.filter(F.when(F.col("l").rlike(_PLACEHOLDER), unfilled(F.col("l"))).otherwise(False))
    open_ones = held.select("doc", line_key(F.col("host"), plain(F.col("l"))).alias("line")).join(_few(common.filter("frame").select("line")), "line", "left_anti").select("doc")
    # evidence where nothing else is said
    suspect = t.filter(possible(F.col("text")))
    line = suspect.select("doc", "host", F.explode_outer(F.split("text", "[\r\n]+")).alias("l"))
    line = line.select("doc", line_key(F.col("host"), F.col("l")).alias("line"), "l")
    one = line.select("doc", "line", F.explode_outer(units(F.col("l"))).alias("whole"))
    one = one.select("doc", "line", F.trim(F.regexp_replace("whole", _NAVIGATION, " ")).alias("u"))
    one = one.withColumn("may", possible(F.col("u")))
    title = ~F.col("u").rlike(r"[。！？!?।؟…；;.][”」』\"'»)）]*$") & (letters(F.col("u")) <= 40) & (F.size(F.split("u", " ")) <= 8)
    judged = one.select("doc", "line", evidence(F.col("u"), F.col("may")).alias("told"), (~title & (letters(F.col("u")) >= 8)).alias("solid"))
    marked = judged.join(common.select("line", F.lit(True).alias("common")), "line", "left").withColumn("common", F.coalesce("common", F.lit(False)))
    own = ~F.col("told") & F.col("solid") & ~F.col("common")
    per = marked.groupBy("doc").agg(F.max(own).alias("own"), F.collect_set(F.when(F.col("told"), F.struct("line", "common"))).alias("told"))
    told = cut(per.select("doc", "own", F.explode("told").alias("e")).select("doc", "own", "e.*"))
    beside = told.filter("common").groupBy("line").agg(F.avg(F.col("own").cast("int")).alias("beside")).filter(F.col("beside") >= BESIDE).select("line")
    empty_ones = told.filter("not own").join(_few(beside), "line", "left_anti").select("doc")
    return open_ones.unionByName(empty_ones).distinct().select(F.col("doc").alias(id_col))


def without_residue(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", url_col: str = "source_url") -> DataFrame:
    """The records that are no residue, all columns kept; those with null ids or texts stay.

    Up to SMALL ids are broadcast, so the texts are not exchanged; beyond that the tables are joined by id.
    """
    gone = cut(residue(docs, id_col, text_col, url_col).select(F.col(id_col).alias("_gone")))
    return docs.join(_few(gone), docs[id_col] == gone["_gone"], "left_anti")
