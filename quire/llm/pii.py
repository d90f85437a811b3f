"""Personal information in free text: e-mail addresses, phone numbers, identity numbers, addresses, names.

Weak supervision.  Patterns propose spans, and patterns, word lists, context cues and the frequency of the span's words
over all texts vote for or against each (labelers may abstain); no cue and no list decides alone.
Expectation-maximisation over the counts of all vote patterns in the corpus estimates how reliable each labeler is and
how likely each pattern is true.  A logistic span classifier on shape and context features, fitted on a bounded sample of
candidates with those likelihoods as soft labels, takes the final decision.
"""

from __future__ import annotations

import bisect
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from quire.plans.lineage import cut

TYPES = ("EMAIL", "PHONE", "ID_NUMBER", "ADDRESS", "NAME")
#: Candidates, first by a hash, that the classifier is fitted on.
FIT_ROWS = 20_000
#: Rows, and share of all rows, from which on the same words are frequent.
FREQUENT, FREQUENT_SHARE = 60, 0.0003
#: Frequent words up to which they may be broadcast.
SMALL = 100_000
#: Buckets of hashed features.
WIDTH = 1 << 14
#: Labelers in the order of the votes; each says +1, 0 or -1.  shape: the pattern is no open one, such as two capital words.
LABELERS = ("shape", "list", "left_cue", "right_cue", "against", "company", "frequent")

# Word lists of the labelers.
GIVEN = frozenset(
    "Adele Agnes Alexander Alice Alma Amelia Andrea Andrew Anna Anthony Arthur Barbara Basil Bella Benjamin Boris Bruno Carla Carlos Caroline Celia Charles Charlotte "
    "Christopher Clara Claudia Daniel Dario David Derek Diana Dmitri Edith Edward Elena Elizabeth Elsa Emil Emily Emma Eva Fabian Felix Fiona Flora "
    "Frances Frank Frederick Gabriel George Gerald Gideon Grace Greta Gustav Hanna Hannah Harold Helen Henrietta Henry Hugo Ida Igor Ingrid Irene "
    "Isaac Isabella Ivan Jana Jack Jacob James Jane Jennifer Jessica Joan John Jonas Jonathan Jose Joseph Juan Judith Julia Julian Karl Kasper Katherine Kenneth Klara "
    "Konrad Laura Lawrence Lena Leo Leon Linda Louis Louise Lucas Lucia Lydia Magnus Maria Margaret Marie Mark Marta Martin Mary Matthew Max Michael Milan Miriam Monica Nadia "
    "Natalie Nicholas Nils Nina Noah Nora Olga Oliver Oscar Otto Pablo Patricia Patrick Paul Paula Pavel Peter Petra Philip Quinn Rachel Rafael Ralph "
    "Rebecca Richard Robert Rosa Ruth Samuel Sandra Sara Sarah Silvia Simon Sofia Sophie Stefan Stephen Susan Theodore Theresa Thomas Tilda Tobias Ulrich Una "
    "Ursula Vera Victor Victoria Vincent Walter Wanda Werner William Xenia Yusuf Yvonne Zeno Zora".split()
)
SURNAMES = (
    "赵钱孙李周吴郑王冯陈褚卫蒋沈韩杨朱秦尤许何吕施张孔曹严华金魏陶姜戚谢邹喻柏水窦章云苏潘葛奚范彭郎鲁韦昌马苗凤花方俞任袁柳"
    "鲍史唐费廉岑薛雷贺倪汤滕殷罗毕郝邬安常乐于时傅皮卞齐康伍余元卜顾孟平黄和穆萧尹姚邵湛汪祁毛禹狄米贝明臧计伏成戴谈宋茅庞熊纪"
    "舒屈项祝董梁杜阮蓝闵席季麻强贾路娄危江童颜郭梅盛林刁钟徐邱骆高夏蔡田樊胡凌霍虞万支柯管卢莫房丁邓洪包左石崔吉龚程邢裴陆荣翁"
    "曾关文白蒙叶温聂龙黎段侯易武刘景詹"
)
DOUBLE_SURNAMES = "欧阳|司马|上官|诸葛|东方|皇甫|尉迟|公孙|慕容|司徒|令狐|夏侯"
ROLE_ENDS = "组部员处科队室局司店厂院校库群团会网台"
NO_NAME_ENDS = "说是有在去来的了将会应需要可"
TITLE = r"(?:Mr|Mrs|Ms|Mx|Miss|Dr|Prof|Eng|Herrn?|Frau|Sr|Sra|Srta|Dra|Don|Doña|Mme|Madame|Monsieur|M)"
STREET = "Street|St|Road|Rd|Lane|Ln|Avenue|Ave|Close|Drive|Dr|Boulevard|Blvd|Way|Court|Ct|Place|Pl|Square|Sq|Terrace|Crescent|Gardens|Grove|Row|Hill|Mews|Walk|Quay|Parade"
COMPANY = "Ltd|Inc|LLC|GmbH|Corp|Co|AG|SA|Group|Limited|PLC|KG"
NOT_A_NAME = frozenset(
    "Yesterday Today Tomorrow Thanks Then Now Here There Our My Your His Her Their We They You He She It And But Or For From With To Also Only Both All Each Every Some Many Most The This That These Those When Since While After Before Because If Though Project Ticket Release Version Meeting Room Level Part Order Default Download Use See "
    "Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August September October November December "
    "Mr Mrs Ms Dr Prof Frau Herr Sra Sr New North South East West Port Lower Upper Old Saint Sie Bitte Frag Fragen Der Die Das Den Dem Ein Eine Im Am Zum Zur Siehe Wer El La Los Las Un Una Según Llame Escriba "
    "Ausweis Auftrag Vorgang Bericht Datei Acceptance Access Change Known Process Interface Home Help Contact Please Call Questions Ship Stop Who Can Is Are Several Acme Mean On In At By Of".split()
) - {"Una"}

_S = r"[ \-. \n]?"
_FULL = {0xFF10 + i: str(i) for i in range(10)} | {ord("＋"): "+", ord("（"): "(", ord("）"): ")", ord("－"): "-", ord("＠"): "@", ord("．"): "."} | {0xFF21 + i: chr(65 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}
_NEEDS_FULL = re.compile("[０-９＋（）－＠．Ａ-Ｚａ-ｚ]")

_AT = r"(?:@|\s?[(\[{【<](?:at|AT|At)[)\]}】>]\s?)"
_DOT = r"(?:\.|\s?[(\[{【<](?:dot|DOT|Dot)[)\]}】>]\s?)"
_EMAIL = re.compile(rf"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]{{0,63}}(?<![.\-]){_AT}[A-Za-z0-9](?:[A-Za-z0-9\-]{{0,62}})(?:{_DOT}[A-Za-z0-9\-]{{1,63}})*{_DOT}[A-Za-z]{{2,24}}(?![A-Za-z0-9])")
_EMAIL_WORDS = re.compile(r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._+\-]{0,63}\s(?:at|AT)\s[A-Za-z0-9\-]{1,63}(?:\s(?:dot|DOT)\s[A-Za-z0-9\-]{2,63})+")
_EMAIL_HINT = re.compile(r"@|[(\[{【<](?:at|AT|At)[)\]}】>]")

_NUMBER = re.compile(
    r"(?<![A-Za-z0-9./\-_+#])(?:"
    r"(?P<twelve>\d{4}[ \-\n]\d{4}[ \-\n]\d{4}(?![ \-]?\d))"
    rf"|(?P<intl>(?:\+|00)\d(?:[ \-. \n()]{{0,2}}\d){{7,13}}(?!\d))"
    rf"|(?P<cn18>\d{{6}}[ \-\n]?\d{{8}}[ \-\n]?\d{{3}}[\dXx](?![A-Za-z0-9]))"
    rf"|(?P<dni>\d{{2}}\.\d{{3}}\.\d{{3}}-?[A-Z]|\d{{8}}-?[A-Z](?![A-Za-z0-9]))"
    rf"|(?P<ssn>\d{{3}}-\d{{2}}-\d{{4}}(?![\d-]))"
    rf"|(?P<area>\(\d{{2,4}}\)[ \-\n]?\d{{3,4}}[ \-\n]?\d{{3,5}}(?!\d))"
    rf"|(?P<mobile>1[3-9]\d[ \-\n]?\d{{4}}[ \-\n]?\d{{4}}(?![ \-.]?\d))"
    rf"|(?P<trunk>0\d{{1,3}}[ \-\n]\d{{3,4}}[ \-\n]?\d{{4}}(?!\d))"
    rf"|(?P<us>\d{{3}}[\-. \n]\d{{3}}[\-. \n]\d{{4}}(?!\d))"
    rf"|(?P<short>\d{{3}}[\-.]\d{{4}}(?![\d\-]))"
    rf"|(?P<nino>[A-Z]{{2}}[ \n]?\d{{2}}[ \n]?\d{{2}}[ \n]?\d{{2}}[ \n]?[A-Z](?![A-Za-z0-9]))"
    rf"|(?P<pass>[A-Z]\d{{2}}[A-Z]\d{{5}}(?![A-Za-z0-9])|[A-Z]{{1,2}}\d{{7,9}}(?![A-Za-z0-9]))"
    rf"|(?P<digits>\d{{7,18}}(?![A-Za-z0-9]))"
    r")"
)
_IS_ID = frozenset(("cn18", "dni", "ssn", "twelve", "nino", "pass"))
_IS_PHONE = frozenset(("intl", "area", "mobile", "trunk", "us", "short"))
_ID_CUE = re.compile(r"(?:身份证|证件|护照|驾照|登録番号|マイナンバー|旅券|passport|Passport|identity|\bID\b|licen[cs]e|SSN|Ausweis|Personalausweis|Reisepass|documento|DNI|NIE|pasaporte|cédula|पहचान|आधार|पासपोर्ट|الهوية|هوية|جواز|บัตรประชาชน|บัตรประจำตัว|หนังสือเดินทาง|เลขประจำตัว)[^\n。；;!?！？]{0,14}$")
_ID_RIGHT = re.compile(r"^\s?(?:已核验|pertenece a|gehört zu|belongs to|for [A-Z]|يخص|[ऀ-ॿ ]{3,20}की है)")
_PHONE_CUE = re.compile(r"(?:电话|手机|号码|拨打|致电|热线|联系|電話|連絡|携帯|call|phone|Phone|Tel|tel|mobile|dial|\bon|On-call:[^:]{0,40}|rufen|unter|Telefon|Llame|teléfono|móvil|\bal|ติดต่อ|โทร|से|फ़ोन|फोन|على|هاتف|الاتصال|さんに)[^\n。；;!?！？A-Z]{0,10}$")
_PHONE_RIGHT = re.compile(r"^\s?(?:停用|で連絡|に電話|about|,\s*build|an\b|पर बात|เพื่อ|，?请拨)")
_NUMBER_AGAINST = re.compile(
    r"(?:订单|编号|批次|流水|序列号|版本|工单|单号|设备|物料|项目|任务|注文|製品|受注|番号REQ|[Oo]rder|[Pp]art number|[Bb]atch|[Bb]uild|[Jj]ob|[Ss]erial|[Rr]elease|[Tt]icket|[Vv]ersion|SN-?|Auftrag|Bestellung|Vorgang|Teilenummer|pedido|caso|pieza|lote|ऑर्डर|मामला|आदेश|الطلب|الحالة|คำสั่งซื้อ|งาน)[号#：:\s\-.No]{0,4}$"
)

_ZH = "一-鿿"
_ZH_STREET = re.compile(rf"(?:路|街|巷|大道|弄|胡同)(?:东|西|南|北|中)?[ \n]?\d{{1,5}}(?:[\-－]\d+)?号(?:院)?(?:[ \n]?\d+(?:栋|幢|座|号楼|楼|单元|层|室|房|户))*")
_ZH_VERB = re.compile(r"(?:寄到|寄往|寄至|寄送|寄|送到|送至|住在|居住于|住|位于|搬到|迁至|地址为|地址是|地址|在|到|于|至|往|为|是|从)(?=[一-鿿]{2,})")
_ZH_PART = re.compile(rf"(?:[{_ZH}]{{2,3}}省)?(?:[{_ZH}]{{2,4}}市)?(?:[{_ZH}]{{1,4}}[区县])?(?:[{_ZH}]{{1,4}}[镇乡])?[{_ZH}]{{1,5}}$")
_EN_CITY = r"[A-Z][a-z]+(?:\s(?:[A-Z][a-z]+)){0,2}"
_EN_ADDRESS = re.compile(
    rf"(?:(?:Flat|Apt\.?|Apartment|Unit|Suite)\s\w{{1,5}},\s)?(?<![\w.])\d{{1,5}}[A-Za-z]?\s(?:[A-Z][A-Za-z']+\s){{1,3}}(?:{STREET})\b(?:\.(?=[,\s]))?"
    rf"(?:,\s(?:Flat|Apt\.?|Apartment|Unit|Suite|Floor)\s\w{{1,5}})?(?:,\s{_EN_CITY})?(?:,?\s(?:[A-Z]{{1,2}}\d{{1,2}}[A-Z]?\s\d[A-Z]{{2}}|(?:[A-Z]{{2}}\s)?\d{{5}}(?:-\d{{4}})?)(?!\w))?"
)
_DE_ADDRESS = re.compile(
    r"(?:[A-ZÄÖÜ][a-zäöüß\-]*(?:straße|strasse|str\.|weg|allee|platz|gasse|ring|damm|ufer|hof|steig|chaussee|markt|graben)|[A-ZÄÖÜ][a-zäöüß]+er\s(?:Straße|Weg|Allee|Platz|Ring|Damm))\s\d{1,4}\s?[a-z]?"
    r"(?:,\s(?:\d{1,2}\.\s(?:OG|Stock|Etage)|EG|DG|Whg\.\s\w+|Wohnung\s\w+))*(?:,\s(?:D-)?\d{5}\s[A-ZÄÖÜ][a-zäöüß]+(?:[ \-](?:[A-ZÄÖÜ][a-zäöüß]+|am|an|der))*)?"
)
_ES_ADDRESS = re.compile(
    r"(?:Calle|C/|Avenida|Avda\.?|Av\.|Paseo|Plaza|Camino|Ronda|Travesía|Carrera)\s(?:d[eo]l?\s(?:la\s|las\s|los\s)?)?[A-ZÁÉÍÓÚÑ][\wáéíóúñ]+(?:\s(?:de\s)?[A-ZÁÉÍÓÚÑ][\wáéíóúñ]+)*,?\s\d{1,4}"
    r"(?:,\s(?:\d{1,2}\.?\s?[ºªo]\.?\s?[A-Z]?\b|bajo(?:\s[A-Z])?|piso\s\d+|puerta\s\w+|local\s\w+))*(?:,\s\d{5}\s[A-ZÁÉÍÓÚÑ][\wáéíóúñ]+(?:\s(?:de\s)?[A-ZÁÉÍÓÚÑ][\wáéíóúñ]+)*)?"
)
_JA_ADDRESS = re.compile(
    r"(?:〒?\d{3}-\d{4}\s?)?(?:[一-鿿]{2,3}[都道府県])?[一-鿿々]{1,4}[市区郡][一-鿿々ヶケぁ-んァ-ヴー]{1,10}?\d{1,3}(?:丁目[ \n]?\d{1,4}(?:(?:番地?|-|－)\d{0,4})*(?:号)?|-\d{1,4}(?:-\d{1,4})*|番地?\d*号?)(?:[ 　]?\d{1,4}(?:号室|階))*"
)
_ADDRESS_LEFT = re.compile(r"(?:寄到|寄往|寄至|寄|送到|住在|住|位于|地址[为是：:]?|送付先は|住所は|宛先は|address[^.]{0,14}:?|to|at|lives in|Lieferung geht an|wohnt in|Anschrift:?|envío va a|dirección[^.]{0,10}:?|vive en|en|a|an|in)\s*$")
_ADDRESS_RIGHT = re.compile(r"^(?:即可|，每周|，收件人|です|に送|,\s*attention|\.\s|\.$|。|，|,|\n|$)")

_W = r"[A-ZÀ-ÖØ-Þ](?:[a-zß-öø-ÿ']+|[A-ZÀ-ÖØ-Þ]+)"
_LATIN = re.compile(rf"(?<![\w@./\-+])(?:[A-Z]\.(?:\s?[A-Z]\.)*|[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)?|[A-Z]{{2,}}(?=\s[A-Z]))(?:\s[A-Z]\.)*\s(?:(?:de|van|von|der|del|la)\s){{0,2}}{_W}(?:-{_W})?(?![\w@])")
_TITLE_LEFT = re.compile(rf"(?<![\w]){TITLE}\.?\s+$")
_NAME_LEFT = re.compile(
    r"(?i:\b(?:according to|attention|attn:?|belongs to|approved by|signed by|written by|led by|(?:please )?(?:contact|call|ask|tell|reach|notify|thank|meet|join|see|email|remind)|called|asked|told|met|thanked|dear|hello|hi|cc:?|colleague|manager|engineer|director|owner|author|reviewer|named?|by|from|for|with|to|and|or|"
    r"gehört zu|rufen sie|kontakt|kollege|kollegin|von|mit|bei|für|an|oder|und|pertenece a|llame a|según|contacto|avise a|con|por|para|y|de|a))\s+$"
)
_NAME_SURE_LEFT = re.compile(r"(?i:\b(?:according to|attention|attn:?|belongs to|approved by|signed by|written by|(?:please )?(?:contact|call|notify|thank)|dear|hello|hi|cc:?|gehört zu|rufen sie|pertenece a|llame a|según|by|from|thanks to|asked|told|met|con|von|mit)|[A-Za-z\-]{3,}:|\d\w{0,20} (?:for|of|de|von))\s+$")
_NAME_RIGHT = re.compile(
    r"^(?:\s(?:signed|approved|asked|said|says|wrote|writes|called|told|met|went|joined|left|sent|led|leads|works|worked|lives|lived|reviewed|reported|confirmed|thinks|wants|needs|will|would|has|had|was|is|and|or|on|at|about|before|after|by|from|hat|ist|war|sagt|sagte|und|oder|zum|unter|am|dijo|es|fue|tiene|y|o|al|en)\b|'s\b|,\s|[.;:!?)]|$|\n)"
)
#: What only persons do.
_NAME_SURE_RIGHT = re.compile(r"^\s(?:signed|approved|asked|said|says|wrote|writes|called|told|met|went|joined|lives|lived|reviewed|thinks|wants|sagt|sagte|schrieb|dijo|escribió)\b")
#: Endings of common nouns, in lower case; names seldom have them.
_NOUN = re.compile(r"^.{3,}(?:tion|sion|ment|ness|ity|ing|ance|ence|ware|ship|ung|heit|keit|schaft|ción|dad|miento|ics|ies|ers|ors)$")

_ZH_NAME_LEFT = re.compile(r"(?:审批人|负责人|联系人|收件人|经办人|申请人|发件人|姓名|客户|用户|请联系|联系|改为|同事|找|名叫|经理|老师|主任|总监|医生|教授|作者|根据|据|叫做|由|与|和|给|，|。|；|：|:|\n|^)[：:为是\s]{0,2}$")
_ZH_STRONG_LEFT = re.compile(r"(?:审批人|负责人|联系人|收件人|经办人|申请人|发件人|姓名|请联系|联系|改为|同事|名叫|叫做)[：:为是\s]{0,2}$")
_ZH_NAME_RIGHT = re.compile(r"^\s?(?:留的|住在|的邮箱|的电话|的手机|的号码|的地址|先生|女士|老师|经理|同学|反馈|说|表示|认为|提出|告诉|负责|签字|审批|提交|参加|出席|主持|加入|离开|去了|来了|昨天|今天|明天|上周|下周|已经|[（(][A-Za-z0-9])")
#: Where a name may begin without a cue: at the start, after a break, a mark or a space.
_ZH_START = re.compile(rf"(?:^|(?<=[\s，。；、！？：:,.;!?（(“\"「【《]))(?=(?:{DOUBLE_SURNAMES}|[{SURNAMES}])[一-鿿]{{1,2}})")
_ZH_STOP = re.compile(r"^(?:[，。；、！？,.;:：（(）)\s]|$)")
_ZH_NAME = re.compile(rf"(?:{DOUBLE_SURNAMES}|[{SURNAMES}])[{_ZH}]{{1,2}}")
_ZH_AFTER = re.compile(
    rf"(?P<cue>(?:审批人|负责人|联系人|收件人|经办人|申请人|发件人|姓名|联系|改为|同事|名叫|叫做|根据|据|请教了?|告诉了?|通知了?|感谢|找|与|给|由(?!于))[：:为是\s]{{0,2}})(?=[{_ZH}])|(?P<run>[{_ZH}]{{2,4}})(?=留的|住在|的邮箱|的电话|的手机|先生|女士|[（(][A-Za-z0-9._+\-]+\s?[@\[(])"
)
# The most common family names.
_JA_FAMILY = "佐藤|鈴木|高橋|田中|伊藤|渡辺|山本|中村|小林|加藤|吉田|山田|佐々木|山口|松本|井上|木村|斎藤|清水|山崎|池田|橋本|阿部|石川|山下|中島|石井|小川|前田|岡田|長谷川|藤田|後藤|近藤|村上|遠藤|青木|坂本|福田|太田"
_JA_LISTED = re.compile(rf"(?<![一-鿿々])(?:{_JA_FAMILY})[ 　]?[一-鿿々]{{1,2}}(?=[はがにをとへもの、。さ]|$)")
_JA_NAME = re.compile(r"(?<![一-鿿々])[一-鿿々]{1,3}[ 　\n]?[一-鿿々ぁ-んァ-ヴ]{1,3}?(?=さん|様|氏|殿|の宛先|の登録番号|の住所|の電話|の連絡先)")
_KANA = re.compile("[ぁ-ヺ様氏殿]")
_JA_RIGHT = re.compile(r"^(?:さん|様|氏|殿|の宛先|の登録番号|の住所|の電話|の連絡先)")
_DEV = "ऀ-ॣॱ-ॿ"
_HI_NAME = re.compile(rf"(?:(?:डॉ\.|श्री|श्रीमती|कृपया|कुमारी)\s+|(?<=\d)\s|(?<=[A-Z])\s)(?P<n>[{_DEV}]{{2,}}\s[{_DEV}]{{2,}})(?=\s(?:ने|से|को|का|की|के|जी)(?![{_DEV}]))")
_HI_ID = re.compile(r"(?:पहचान|आधार|पासपोर्ट)[^।]{0,16}\d[A-Z]?\s$")
_AR = "؀-ؿف-ي"
_AR_NAME = re.compile(r"(?:(?<![\w])د\.\s+|السيدة?\s+|الاتصال بـ\s*|الاتصال ب|يخص\s+|إلى السيدة?\s+|المهندسة?\s+)(?P<n>[ء-يً-ْ]{2,}\s[ء-يً-ْ]{2,})(?=\s(?:أن|على|في|عن)|[.،؟!]|$|\n)")
_TH_NAME = re.compile(r"(?<![ก-๎])(?:คุณ|นางสาว|นาย|นาง|ดร\.\s?)(?P<n>[ก-๎]{2,15}\s[ก-๎]{2,15})(?=\s|$)")


def candidates(text: str) -> list[tuple[int, int, str, tuple[int, ...], str]]:
    """(start, end, type, votes, shape) of non-overlapping spans that might be personal information."""
    t = text.translate(_FULL) if _NEEDS_FULL.search(text) else text
    out: list[tuple[int, int, str, tuple[int, ...], str]] = []

    starts: list[int] = []
    ends: list[int] = []

    def add(a: int, b: int, kind: str, votes: tuple[int, ...], shape: str) -> None:
        i = bisect.bisect_left(starts, b)  # spans so far do not overlap, so only the one before b can meet [a, b)
        if a < b and (not i or ends[i - 1] <= a):
            starts.insert(i, a)
            ends.insert(i, b)
            out.append((a, b, kind, votes, shape))

    if _EMAIL_HINT.search(t):
        for m in _EMAIL.finditer(t):
            url = re.search(r"(?:https?|ftp|ssh|git)://\S*$", t[max(0, m.start() - 200) : m.start()])
            add(*m.span(), "EMAIL", (1, 1, 0, 0, -1 if url else 0, 0), "plain" if "@" in m.group() else "disguised")
    if "dot" in t or "DOT" in t:
        for m in _EMAIL_WORDS.finditer(t):
            add(*m.span(), "EMAIL", (1, 0, 0, 0, 0, 0), "words")
    _addresses(t, add)
    for m in _NUMBER.finditer(t):
        _number(t, m, add)
    _names(t, add)
    return sorted(out)


def _addresses(t: str, add) -> None:  # noqa: ANN001
    if "号" in t:
        for m in _ZH_STREET.finditer(t):
            left = re.search(rf"[{_ZH}]*$", t[max(0, m.start() - 24) : m.start()]).group()
            verbs = list(_ZH_VERB.finditer(left + m.group()[0] * 0 + "路路"))
            verbs = [v for v in verbs if v.end() < len(left)] or [None]
            if verbs[-1] is not None:
                left = left[verbs[-1].end() :]
            part = _ZH_PART.search(left)
            if part:
                a = m.start() - len(part.group())
                head = t[max(0, a - 14) : a]
                cue = 1 if _ADDRESS_LEFT.search(head) else 0
                named = 1 if re.search(r"[市区县]", part.group()) else 0
                add(a, m.end(), "ADDRESS", (1, named, cue, 1 if _ADDRESS_RIGHT.search(t[m.end() : m.end() + 12]) else 0, 0, 0), "zh")
    for kind, pattern, hint in (
        ("en", _EN_ADDRESS, None),
        ("de", _DE_ADDRESS, None),
        ("es", _ES_ADDRESS, None),
        ("ja", _JA_ADDRESS, "市区郡"),
    ):
        if hint and not any(h in t for h in hint):
            continue
        for m in pattern.finditer(t):
            a, b = m.span()
            while t[b - 1] in ".,;: \n":
                b -= 1
            more = 1 if re.search(r"\d{5}\s|[A-Z]\d+ \d[A-Z]{2}|丁目", m.group()) else 0
            cue = 1 if _ADDRESS_LEFT.search(t[max(0, a - 24) : a]) else 0
            add(a, b, "ADDRESS", (1, more, cue, 1 if _ADDRESS_RIGHT.search(t[b : b + 16]) else 0, 0, 0), kind)


def _number(t: str, m: re.Match, add) -> None:  # noqa: ANN001
    form, (a, b) = m.lastgroup, m.span()
    left, right = t[max(0, a - 48) : a].replace("\n", " "), t[b : b + 24].replace("\n", " ")
    id_cue, phone_cue = bool(_ID_CUE.search(left[-40:])), bool(_PHONE_CUE.search(left))
    id_right, phone_right = bool(_ID_RIGHT.search(right)), bool(_PHONE_RIGHT.search(right))
    against = bool(_NUMBER_AGAINST.search(left[-16:]))
    if form == "digits":
        if not (id_cue or phone_cue or id_right or phone_right):
            return
        kind = "ID_NUMBER" if id_cue or id_right else "PHONE"
        if kind == "PHONE" and b - a > 13:
            return
    elif form in _IS_ID:
        kind = "PHONE" if form in ("twelve", "ssn") and phone_cue and not id_cue and not id_right else "ID_NUMBER"
    else:
        kind = "ID_NUMBER" if id_cue and not phone_cue and form in ("us", "trunk", "mobile") else "PHONE"
    cue, after = (id_cue, id_right) if kind == "ID_NUMBER" else (phone_cue, phone_right)
    shape = -1 if form == "digits" else 1
    digits = sum(c.isdigit() for c in m.group())
    fits = 1 if (kind == "PHONE" and form in _IS_PHONE and 7 <= digits <= 15) or (kind == "ID_NUMBER" and form in ("cn18", "dni", "nino")) else 0
    add(a, b, kind, (shape, fits, int(cue), int(after), -int(against), 0), form)


def _names(t: str, add) -> None:  # noqa: ANN001
    at, low = 0, None
    while m := _LATIN.search(t, at):
        a, b = m.span()
        words = re.split(r"[\s\-]", m.group())
        first, last = words[0].rstrip("."), words[-1]
        step = re.search(r"\s", m.group())
        later = step and _LATIN.match(t, a + step.end())
        given = later and re.split(r"[\s\-.]", later.group(), maxsplit=1)[0].title() in GIVEN  # the name begins there
        if last in NOT_A_NAME or len(first) > 1 and (first in NOT_A_NAME or given and first.title() not in GIVEN):
            at = a + (step.end() if step else 1)  # the first word may be no part of a name: go on at the next
            continue
        left, right = t[max(0, a - 32) : a].replace("\n", " "), t[b : b + 18].replace("\n", " ")
        initial, known = len(first) == 1, first.title() in GIVEN
        title, cue = bool(_TITLE_LEFT.search(left)), bool(_NAME_LEFT.search(left))
        if initial and not (title or cue or _NAME_RIGHT.search(right)):
            at = a + (step.end() if step else 1)
            continue
        if low is None:
            low = frozenset(re.findall(r"(?<![\w])[a-zß-öø-ÿ]{3,}", t))
        noun = any(w.lower() in low or _NOUN.search(w.lower()) for w in words)
        company = last in COMPANY.split("|") or bool(re.match(rf"\s(?:{COMPANY})\b", right))
        left_vote = 1 if title or _NAME_SURE_LEFT.search(left) or _NAME_SURE_RIGHT.search(right) else 0
        add(a, b, "NAME", (int(known or left_vote or initial), int(known), left_vote, int(bool(_NAME_RIGHT.search(right)) or cue), -int(noun and not known), -int(company)), "initial" if initial else "latin" if known or left_vote else "open")
        at = b
    spots = set()
    for m in _ZH_AFTER.finditer(t):
        if m.lastgroup == "cue":
            spots.add(m.end())
        else:
            spots |= set(range(m.start(), m.end() - 1))
    loose = {m.start() for m in _ZH_START.finditer(t)} - spots
    for a in sorted(spots | loose):
        m = _ZH_NAME.match(t, a)
        if not m:
            continue
        left = t[max(0, a - 10) : a]
        strong, weak = bool(_ZH_STRONG_LEFT.search(left)), bool(_ZH_NAME_LEFT.search(left))
        base = 2 if re.match(DOUBLE_SURNAMES, m.group()) else 1
        best = None
        for n in (base + 2, base + 1):
            if len(t) < a + n or not re.fullmatch(rf"[{_ZH}]+", t[a : a + n]) or t[a + n - 1] in NO_NAME_ENDS:
                continue
            rest = t[a + n : a + n + 8]
            cue, stop = bool(_ZH_NAME_RIGHT.search(rest)), bool(_ZH_STOP.search(rest))
            if cue or stop:
                best = (a + n, cue, stop)
                break
        if best is None and strong:
            best = (m.end(), False, False)
        if best and (strong or best[1] or t[a - 1 : a] in ("：", ":")):
            b, cue, stop = best
            if t[b - 1] in ROLE_ENDS or t[b : b + 1] in set(ROLE_ENDS):  # a team or a role, as in 管理员
                continue
            named = strong or a in spots
            add(a, b, "NAME", (int(named), 1, int(strong or t[a - 1 : a] in ("：", ":")), int(cue or stop and (strong or weak)), 0, 0), "zh" if named else "zh open")
    if _KANA.search(t):
        for m in _JA_NAME.finditer(t):
            add(*m.span(), "NAME", (1, 0, 0, 1 if _JA_RIGHT.match(t, m.end()) or _JA_RIGHT.search(t[m.end() : m.end() + 8]) else 0, 0, -int(t[m.end() - 1] in ROLE_ENDS)), "ja")
        for m in _JA_LISTED.finditer(t):
            add(*m.span(), "NAME", (0, 1, 0, 0, 0, -int(t[m.end() - 1] in ROLE_ENDS)), "ja listed")
    for pattern, kind in ((_HI_NAME, "hi"), (_AR_NAME, "ar"), (_TH_NAME, "th")):
        for m in pattern.finditer(t):
            a = m.start("n")
            if kind == "hi" and m.start("n") - m.start() < 2 and not _HI_ID.search(t[max(0, a - 40) : a]):
                continue
            add(a, m.end("n"), "NAME", (1, 0, 1, 1, 0, 0), kind)


def features(text: str, a: int, b: int, kind: str, votes: tuple[int, ...], shape: str) -> list[int]:
    """Hashed features of a candidate: its votes, shape, and the text beside it."""
    left, right = text[max(0, a - 12) : a].lower(), text[b : b + 12].lower()
    lw, rw = left.split()[-1:] or [""], right.split()[:1] or [""]
    names = [kind, f"{kind}/{shape}", f"{kind}<{left[-1:]}", f"{kind}<{left[-2:]}", f"{kind}<{left[-3:]}", f"{kind}>{right[:1]}", f"{kind}>{right[:2]}", f"{kind}>{right[:3]}"]
    names += [f"{kind}<w{lw[0]}", f"{kind}>w{rw[0]}", f"{kind}#{min(b - a, 40) // 4}", f"{kind}v{votes}"]
    names += [f"{kind}{n}{v}" for n, v in zip(LABELERS, votes)]
    return [zlib.crc32(n.encode()) % WIDTH for n in names]


_FOUND = ArrayType(
    StructType(
        [
            StructField("start_pos", IntegerType()),
            StructField("end_pos", IntegerType()),
            StructField("pii_type", StringType()),
            StructField("votes", StringType()),
            StructField("said", StringType()),
            StructField("features", ArrayType(IntegerType())),
        ]
    )
)


def proposed(text: Column) -> Column:
    """Candidates of a text with votes and features."""

    @F.arrow_udf(_FOUND)
    def run(column: pa.Array) -> pa.Array:
        size, start, end, kind, votes, said, feats = [0], [], [], [], [], [], []
        for t in column.to_pylist():
            for a, b, k, v, s in candidates(t) if t else ():
                start.append(a)
                end.append(b)
                kind.append(k)
                votes.append(",".join(map(str, v)))
                said.append(t[a:b] if k == "NAME" else None)
                feats.append(features(t, a, b, k, v, s))
            size.append(len(start))
        parts = [pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(kind, pa.string()), pa.array(votes, pa.string()), pa.array(said, pa.string()), pa.array(feats, pa.list_(pa.int32()))]
        return pa.ListArray.from_arrays(pa.array(size, pa.int32()), pa.StructArray.from_arrays(parts, ["start_pos", "end_pos", "pii_type", "votes", "said", "features"]))

    return run(text)


def likelihoods(counts: list[tuple[str, str, int]], rounds: int = 30) -> dict[tuple[str, str], float]:
    """Chance that a vote pattern is true, by expectation-maximisation over (type, votes, count) within each type."""
    out = {}
    for kind in TYPES:
        own = [(np.array(v.split(","), dtype=int), v, n) for k, v, n in counts if k == kind]
        if not own:
            continue
        votes, n = np.array([v for v, _, _ in own]), np.array([c for _, _, c in own], dtype=float)
        p = 1 / (1 + np.exp(-(votes.sum(axis=1) - 0.5 + 3 * np.minimum(votes.min(axis=1), 0))))
        for _ in range(rounds):
            prior = ((p * n).sum() + 2) / (n.sum() + 3)
            logit = np.full(len(own), np.log(prior / (1 - prior)))
            for j in range(votes.shape[1]):
                for said in (-1, 0, 1):
                    here = votes[:, j] == said
                    if not here.any():
                        continue
                    # a vote for can be weak evidence, never evidence against; likewise the other way round
                    yes = ((p * n)[here].sum() + 1 + (said > 0)) / ((p * n).sum() + 4)
                    no = (((1 - p) * n)[here].sum() + 1 + (said < 0)) / (((1 - p) * n).sum() + 4)
                    ratio = np.log(yes / no)
                    logit[here] += max(ratio, 0.0) if said > 0 else min(ratio, -3.0) if said < 0 else np.clip(ratio, -1.0, 1.0)
            p = 1 / (1 + np.exp(-np.clip(logit, -12, 12)))
        out |= {(kind, v): float(x) for (_, v, _), x in zip(own, p)}
    return out


def fit(rows: list[list[int]], target: np.ndarray, rounds: int = 120, rate: float = 0.1, decay: float = 1e-4) -> np.ndarray:
    """Logistic weights over hashed features for soft targets; Adam on the whole sample."""
    w = np.zeros(WIDTH)
    if not len(rows):
        return w
    x = np.array(rows)
    m, v = np.zeros(WIDTH), np.zeros(WIDTH)
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(w[x].sum(axis=1), -30, 30)))
        g = np.bincount(x.ravel(), weights=np.repeat(p - target, x.shape[1]), minlength=WIDTH) / len(x) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def chance(feats: Column, weights: np.ndarray) -> Column:
    w = weights.astype(np.float32)

    @F.arrow_udf(DoubleType())
    def run(column: pa.Array) -> pa.Array:
        if not len(column):
            return pa.array([], pa.float64())
        x = column.flatten().to_numpy().reshape(len(column), -1)
        return pa.array(1 / (1 + np.exp(-np.clip(w[x].sum(axis=1, dtype=np.float64), -30, 30))))

    return run(feats)


_OFTEN, _RARE = zlib.crc32(b"frequent") % WIDTH, zlib.crc32(b"rare") % WIDTH


def _frequent(p: DataFrame) -> DataFrame:
    """(said): words that were proposed as a name in many rows.  Names are rare, so what stands in FREQUENT_SHARE of all
    rows is most likely a common word.  There are no more of them than candidates over the bound."""
    said = p.select(F.explode("c.said").alias("said")).filter("said is not null")
    return cut(said.groupBy("said").agg(F.count("*").alias("n")).filter(F.col("n") >= max(FREQUENT, FREQUENT_SHARE * p.count())).select("said"))


def _judged(p: DataFrame, often: DataFrame) -> DataFrame:
    """Candidates of p (src, row_id, c), one row each, with all votes and features."""
    each = p.select("src", "row_id", F.explode("c").alias("c")).select("src", "row_id", "c.*")
    few = F.broadcast(often) if often.limit(SMALL + 1).count() <= SMALL else often
    each = each.join(few.withColumn("often", F.lit(True)), "said", "left").withColumn("often", F.coalesce("often", F.lit(False)))
    votes, mark = F.concat("votes", F.when(F.col("often"), ",-1").otherwise(",0")), F.when(F.col("often"), _OFTEN).otherwise(_RARE).cast("int")
    return each.select("src", "row_id", "start_pos", "end_pos", "pii_type", votes.alias("votes"), F.array_append("features", mark).alias("features"))


def _weights(each: DataFrame) -> np.ndarray:
    counts = [(r.pii_type, r.votes, r["count"]) for r in each.groupBy("pii_type", "votes").count().collect()]
    true = likelihoods(sorted(counts))
    total = max(1, sum(n for _, _, n in counts))
    # a hash below a share of its range picks about FIT_ROWS candidates without sorting them
    near = F.shiftrightunsigned(F.xxhash64("src", "row_id", "start_pos", "end_pos"), 1) < min(2**63 - 1, int(FIT_ROWS / total * 2**63))
    sample = sorted(each.filter(near).select("pii_type", "votes", "features").limit(2 * FIT_ROWS).collect())
    return fit([r.features for r in sample], np.array([true[r.pii_type, r.votes] for r in sample]))


def mentions(texts: DataFrame) -> DataFrame:
    """(src, row_id, start_pos, end_pos, pii_type) of every mention in texts (src, row_id, text).

    Null and empty texts have none; repeated rows each give theirs.  Positions are code points, end exclusive.
    """
    p = cut(texts.filter(F.length("text") > 0).select("src", "row_id", proposed(F.col("text")).alias("c")))  # the patterns run once
    each = cut(_judged(p, _frequent(p)))
    return each.filter(chance(F.col("features"), _weights(each)) >= 0.5).select("src", "row_id", "start_pos", "end_pos", "pii_type")


def _kept(found: Column, weights: np.ndarray, often: frozenset[str]) -> Column:
    """The mentions among a row's candidates, in order."""
    w = weights.astype(np.float32)

    @F.arrow_udf("array<struct<start_pos:int,end_pos:int,pii_type:string>>")
    def run(column: pa.Array) -> pa.Array:
        flat = column.flatten()
        size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        good = np.zeros(len(flat), dtype=bool)
        if len(flat):
            x = flat.field("features").flatten().to_numpy().reshape(len(flat), -1)
            mark = w[[_OFTEN if s in often else _RARE for s in flat.field("said").to_pylist()]]
            good = w[x].sum(axis=1, dtype=np.float64) + mark >= 0
        ends_at = np.concatenate([[0], np.cumsum(good)])[np.concatenate([[0], np.cumsum(size)])]
        left = flat.filter(pa.array(good))
        parts = [left.field(n) for n in ("start_pos", "end_pos", "pii_type")]
        return pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), pa.StructArray.from_arrays(parts, ["start_pos", "end_pos", "pii_type"]))

    return run(found)


def redacted(texts: DataFrame) -> DataFrame:
    """(src, row_id, text, mentions) of all texts: each mention replaced by its type in angle brackets.

    Null texts stay null; repeated rows each come out.  The texts are written once, with their candidates, to the shared
    folder and never exchanged.  (More than SMALL frequent words would not be told to the tasks; the candidates are then
    judged in a table of their own and joined by (src, row_id), which must be a key.)
    """
    p = cut(texts.select("src", "row_id", "text", F.when(F.length("text") > 0, proposed(F.col("text"))).alias("c")))
    slim = p.select("src", "row_id", "c").filter(F.size("c") > 0)
    often = _frequent(slim)
    each = _judged(slim, often)
    words = [r.said for r in often.limit(SMALL + 1).collect()]
    weights = _weights(each)
    if len(words) <= SMALL:
        joined = p.withColumn("s", F.when(F.col("c").isNotNull(), _kept(F.coalesce("c", F.array().cast(p.schema["c"].dataType)), weights, frozenset(words))))
    else:
        found = each.filter(chance(F.col("features"), weights) >= 0.5).groupBy("src", "row_id").agg(F.sort_array(F.collect_list(F.struct("start_pos", "end_pos", "pii_type"))).alias("s"))
        joined = p.select("src", "row_id", "text").join(found, ["src", "row_id"], "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        kept = F.substring(F.col("text"), acc["at"] + 1, m["start_pos"] - acc["at"])
        return F.struct(m["end_pos"].alias("at"), F.concat(acc["out"], kept, F.lit("<"), m["pii_type"], F.lit(">")).alias("out"))

    done = F.aggregate("s", start, step)
    clean = F.when(F.coalesce(F.size("s"), F.lit(0)) <= 0, F.col("text")).otherwise(F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.length("text"))))
    return joined.select("src", "row_id", clean.alias("text"), F.greatest(F.coalesce(F.size("s"), F.lit(0)), F.lit(0)).alias("mentions"))
