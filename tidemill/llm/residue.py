"""Problem 4: template residue, filler and error-page text within and instead of content.

Messages are the lines and sentences of a content, with their urls, ids and numbers masked. A prefix tree of fixed
depth (number of tokens, first tokens, last one) mines templates from the messages of all contents: in a leaf the messages
come by frequency, each joins the first template of which it shares enough tokens or begins a new one. A template
is classified once, by its most frequent message, and all its messages have its verdict. Unfilled slots and unset
values are searched for in each content by themselves, as they stand inside ordinary sentences. The tree sees every
message once, with its count, in an order of its own, so results are the same however rows are spread over tasks.
"""

from __future__ import annotations

import re
import re._parser as _parser
import unicodedata
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.runtime import checkpointed, ship, spread

#: Depth of the tree in tokens, and the share of equal tokens by which a message joins a template.
DEPTH, SIMILARITY = 6, 0.7
#: Messages with a verdict that are sent to every task; more of them are joined.
SENT = 1_000_000
#: Messages that a task counts before it hands them on.
_HELD = 200_000
#: Templates of a leaf that are compared one by one.
_FEW = 8

# ---- fixed values: what templates, servers and scripts leave behind ------------------------------------------

_NAME = r"[\w.一-鿿-]{1,40}"
SLOTS = re.compile(
    rf"\{{\{{\s*{_NAME}\s*(?:\|[^}}]*)?\}}\}}|[$#]\{{\s*{_NAME}\s*\}}|\{{\$?{_NAME}\}}|\{{%-?\s*\w+[^%]{{0,80}}%\}}|<%[=-]?\s*[^%]{{1,80}}%>"
    rf"|@@{_NAME}@@|\[\[\s*{_NAME}\s*\]\]|%\({_NAME}\)[sdf]|&lt;{_NAME}&gt;|__[A-Za-z一-鿿][\w.一-鿿-]{{0,38}}?__|%%{_NAME}%%"
    r"|[【\[（(<{](?:请|請)?(?:在此|在此处)?(?:输入|輸入|填写|填寫|插入|替换为|替換為)[^】\]）)>}]{0,20}[】\]）)>}]"
)
_UNSET = r"(?:\(null\)|null|undefined|NaN|None|nil)"
UNSET = re.compile(
    rf"\[object \w+\]|NaN(?:[-:/ ]NaN)+|^\W*(?:<[^>]+>)*\s*{_UNSET}\s*(?:<[^>]+>)*\W*$"
    rf"|[:：=]\s*{_UNSET}(?![\w ]*[a-z])|(?<=[一-鿿])\s*(?:NaN|None|null|undefined)\s*(?=[%％元倍股手点點万亿億萬人，。；\n]|$)"
)
_LATIN_FILLER = frozenset(
    "ad adipiscing aliqua aliquip amet anim aute cillum commodo consectetur consequat culpa cupidatat deserunt dolor dolore duis ea eiusmod elit "
    "enim esse est et eu ex excepteur exercitation fugiat id in incididunt ipsum irure labore laboris laborum lorem magna minim mollit nisi non "
    "nostrud nulla occaecat officia pariatur proident qui quis reprehenderit sed sint sit sunt tempor ullamco ut velit veniam voluptate".split()
)
_LATIN = re.compile(r"[A-Za-z]+")
FILLER = re.compile(
    r"上线前请替换|上線前請替換|用于排版预览|用於排版預覽|发布前填写|發布前填寫|在发布前.{0,6}填写|正文不限|标题最多.{1,6}字|標題最多.{1,6}字|编辑部测试稿|編輯部測試稿"
    r"|(?:这|這)是一段(?:占位|佔位|测试|測試|示例)|此处为(?:正文|标题|摘要)?(?:示例|占位)|此處為(?:正文|標題|摘要)?(?:示例|佔位)|测试稿.{0,12}删除|測試稿.{0,12}刪除"
    r"|(?:标题|標題|正文|摘要|图片|圖片)(?:占位|佔位)|^\W*(?:TODO|FIXME|TBD)\b|[Rr]eplace this (?:paragraph|text)|your own (?:copy|text) (?:before|here)|(?:pls|please) ignore|[Ll]orem ipsum|[Ii]nsert (?:text|title) here|[Tt]his is (?:a )?(?:placeholder|dummy)"
)
_REPEATED = re.compile(r"^\W*(?P<unit>\w{1,8}?)(?:\s*(?P=unit)){3,}\s*\w{0,7}\W*$")
ERRORS = re.compile(
    r"(?:^|>|\W)[45]\d\d\s*[-:]?\s*(?:Bad Gateway|Not Found|Forbidden|Gateway Time-?out|Service (?:Temporarily )?Unavailable|Internal Server Error|Bad Request|Unauthorized|Too Many Requests)"
    r"|Access Denied|Too many requests|[Ee]rror establishing a|(?:could not|can(?:no|')t) (?:find what you|be (?:reached|displayed))|upstream (?:connect|request)|Internal error|[A-Z][a-z]+Error: |Exception in thread|Traceback \(most|requested URL|was not found on this server|Reference #"
    r"|(?:页面|頁面|网页|網頁)(?:走丢|走失|不存在|找不到|已失效|已过期|已過期|被删除)|(?:访问|訪問|请求|請求)的?(?:页面|頁面|内容|內容|资源|帖子)(?:不存在|已被|已经|未找到)"
    r"|(?:服务器|伺服器|系统|系統|网络|網絡|網路)(?:开小差|開小差|异常|異常|繁忙|错误|錯誤|超时|逾時|维护中|維護中|升级中|升級中)|(?:服务|服務|网站|網站|页面|頁面)(?:暂时|暫時|暂|暫|当前|當前)?(?:不可用|无法访问|無法訪問)|(?:无权|無權|没有权限|沒有權限)(?:访问|訪問|查看|浏览|瀏覽)(?:此|该|該|本)?(?:页|頁|内容|內容|资源|資源)|(?:稍后|稍後|稍候)(?:再试|再試|重试|重試)|(?:点击|點擊|點按)(?:重试|重試|刷新)"
    r"|(?:请|請)(?:重新|先)?(?:登录|登錄|登入)|(?:会话|會話|登录|登錄)(?:已|状态已)?(?:过期|過期|失效)|(?:请求|請求)?参数(?:有误|错误)|參數(?:有誤|錯誤)|(?:数据|數據|加载|載入)(?:加载|載入)?(?:失败|失敗)"
    r"|(?:该|該|此|本)?(?:帖子|文章|内容|內容|主题)已被?(?:作者|管理员|版主)?(?:删除|刪除|屏蔽)|(?:正在|等待)(?:审核|審核)|<html>|<center>|nginx/"
    r"|(?:请|請)(?:先)?(?:完成|通过|通過|进行|進行|输入|輸入)?.{0,6}(?:验证码|驗證碼|滑块|滑塊|身份核验|身份核驗|人机验证|安全验证|安全驗證)|(?:按住|拖动|拖動).{0,4}滑[块塊]|滑[块塊]验证后|安全[验驗][证證][:：]"
    r"|(?:您|你)的(?:访问|訪問|请求|請求|操作)(?:过于|過於|太)?(?:频繁|頻繁)"
)
_SCRIPT = r"(?:JavaScript|Javascript|javascript|JS\b|脚本|腳本|scripts?\b|cookies?\b|Cookie)"
SCRIPTS = re.compile(
    rf"<noscript|(?:请|請)(?:先|您|在.{{0,8}}中)?.{{0,4}}(?:启用|啟用|开启|開啟|打开|打開|允许|允許).{{0,12}}{_SCRIPT}|(?:需要|必须|必須|要求).{{0,4}}{_SCRIPT}(?:支持|支援|才能正常|功能)"
    rf"|{_SCRIPT}.{{0,8}}(?:被(?:拦截|攔截|禁用|屏蔽)|未启用|未啟用|已禁用)|(?:禁用|屏蔽)了?{_SCRIPT}|(?:浏览器|瀏覽器)(?:版本)?(?:过低|過低|太旧|太舊|不支持|不支援)|(?:升级|升級|更换|更換)(?:您的)?(?:浏览器|瀏覽器)"
    rf"|(?:enable|turn on|activate|allow)(?: \w+){{0,3}} {_SCRIPT}|(?:requires?|needs?|without) {_SCRIPT}|{_SCRIPT} (?:is|are|has been) (?:disabled|required|blocked|turned off)|(?:update|upgrade) your browser|browser is (?:not supported|out of date)"
)
#: Sentences that report about such things instead of being one.
REPORTS = re.compile(
    r"称|稱|表示|认为|認為|引发|引發|投诉|投訴|已恢复|已恢復|投资者|投資者|(?:该|該)平台|建议用|建議用|公司|股东|股東|编辑认为|记者|記者|(?:要求|提醒|提示)(?:用户|用戶|客户|客戶)|hypothesis|told|said|analysts|reported|一度"
)


def _needed(parsed) -> set[str] | None:
    """Literals of which every match of a parsed pattern holds at least one; None if there are no such literals.

    Of a sequence, the part with the longest shortest literal decides; alternatives need a literal each.
    """
    best, run = None, ""

    def better(found: set[str] | None) -> set[str] | None:
        return found if found and (best is None or min(map(len, found)) > min(map(len, best))) else best

    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            run += chr(value)
            continue
        best, run = better({run} if run else None), ""
        if name == "SUBPATTERN":
            best = better(_needed(value[-1]))
        elif name == "MAX_REPEAT" or name == "MIN_REPEAT":
            best = better(_needed(value[2]) if value[0] else None)
        elif name == "BRANCH":
            parts = [_needed(part) for part in value[1]]
            best = better(set().union(*parts) if all(parts) else None)
        elif name == "IN" and all(str(kind) == "LITERAL" for kind, _ in value):
            best = better({chr(code) for _, code in value})
    return better({run} if run else None)


def _literals(*patterns: re.Pattern) -> list[str]:
    """Literals of which every match of any of the patterns holds at least one, derived from the patterns."""
    out = set()
    for pattern in patterns:
        needed = _needed(_parser.parse(pattern.pattern, pattern.flags))
        if needed is None:
            raise ValueError(f"a match of {pattern.pattern[:60]} needs no literal")
        out |= needed
    return sorted(c for c in out if not any(d in c for d in out if d != c))


#: One of the literals that a match of the patterns of templates needs; derived from the patterns, so nothing is lost.
_SIGN = re.compile("|".join(map(re.escape, _literals(FILLER, ERRORS, SCRIPTS))))
#: Literals of which every message with a verdict holds one, but for repeated units and Latin filler.
_CUES = _literals(SLOTS, UNSET, FILLER, ERRORS, SCRIPTS)
#: Traditional characters of the patterns and their simplified forms, pairwise.
_SIMPLE = str.maketrans(
    "頁網絡務錯誤數過驗證塊腳瀏覽請開啟關訪問帳戶維護載參級標題繼續顯頻異點擊試錄會話寫輸處輯審檢測權刪內須為發後這佔預樣許攔換網動拖從門們兩標編",
    "页网络务错误数过验证块脚浏览请开启关访问帐户维护载参级标题继续显频异点击试录会话写输处辑审检测权删内须为发后这占预样许拦换网动拖从门们两标编",
)
_TRADITIONAL = re.compile("[" + "".join(map(chr, _SIMPLE)) + "]")
_DISTURBED = re.compile("[\u00ad\u180e\u200b-\u200f\u2060-\u2064\ufe0e\ufeff\uff10-\uff19\uff21-\uff3a\uff41-\uff5a\u2e80-\u2fd5\uf900-\ufaff]")
_INVISIBLE = re.compile("[\u00ad\u180e\u200b-\u200f\u2060-\u2064\ufe0e\ufeff]")


_BREAK = re.compile(r"(?<=[。！？!?\n])|(?<=\. )")
_MASKS = ((re.compile(r"https?://[^\s。！？!?]+"), "<url>"), (re.compile(r"\b(?=[0-9a-f]*\d)[0-9a-f]{4,}\b"), "<id>"), (re.compile(r"\d+(?:\.\d+)?"), "<n>"))
_TOKEN = re.compile(r"<\w+>|[A-Za-z_]+|[㐀-鿿]|\S")
#: Digits that tell what a message is: status codes before their name, units over and over.
_TELLING = re.compile(r"\b[45]\d\d\b(?=\s*[-:]?\s*[A-Z])|(?<![\d.])(\d{1,4})\1{3,}\d{0,3}(?![\d.])")
_MAY_TELL = re.compile(r"\d{4}|\b[45]\d\d\W{0,4}[A-Z]")
_AWAY, _BACK = (str.maketrans(x, y) for x, y in (("0123456789", "\ue000\ue001\ue002\ue003\ue004\ue005\ue006\ue007\ue008\ue009"), ("\ue000\ue001\ue002\ue003\ue004\ue005\ue006\ue007\ue008\ue009", "0123456789")))


def masked(content: str) -> str:
    """A content with the variable parts of its messages, urls, ids and numbers, masked; digits that tell what a message is stay."""
    kept = _MAY_TELL.search(content) and _TELLING.search(content)
    if kept:
        content = _TELLING.sub(lambda m: m.group().translate(_AWAY), content)
    for pattern, name in _MASKS:
        content = pattern.sub(name, content)
    return content.translate(_BACK) if kept else content


def mask(message: str) -> str:
    """A message with its variable parts masked and its white space in one form."""
    return " ".join(masked(message).split())


def spelled(content: str) -> str:
    """A content without signs that only hide what it says, in simplified characters as far as the patterns know them."""
    if _DISTURBED.search(content):
        content = unicodedata.normalize("NFKC", _INVISIBLE.sub("", content))
    return content.translate(_SIMPLE) if _TRADITIONAL.search(content) else content


class Template:
    """A template: its first message, which decides what joins, its form with wildcards, its verdict and its messages."""

    __slots__ = ("first", "tokens", "shown", "messages", "kind")

    def __init__(self, message: str, tokens: list[str]):
        self.first, self.tokens, self.shown, self.messages = message, tokens, list(tokens), 0
        self.kind = template_kind(message)

    def join(self, tokens: list[str], times: int) -> None:
        self.messages += times
        if tokens is not self.tokens and tokens != self.tokens:
            self.shown = [a if a == b else "<*>" for a, b in zip(self.shown, tokens)]


class Leaf:
    """The templates of one path, in the order in which they came."""

    __slots__ = ("templates", "numbers", "rows")

    def __init__(self):
        self.templates: list[Template] = []
        self.numbers: dict[str, int] = {}
        self.rows = np.zeros((0, 0), np.int32)

    def _row(self, tokens: list[str]) -> list[int]:
        return [self.numbers.setdefault(t, len(self.numbers)) for t in tokens]

    def find(self, tokens: list[str], enough: float) -> Template | None:
        """The first template of which so many tokens are equal; all at once where there are many."""
        n = len(self.templates)
        if n <= _FEW:
            return next((t for t in self.templates if sum(map(eq, t.tokens, tokens)) >= enough), None)
        hits = (self.rows[:n] == np.array(self._row(tokens), np.int32)).sum(1) >= enough
        at = int(hits.argmax())
        return self.templates[at] if hits[at] else None

    def append(self, template: Template) -> None:
        self.templates.append(template)
        n = len(self.templates)
        if n > _FEW:
            if n > len(self.rows):
                rows = np.zeros((2 * n, len(template.tokens)), np.int32)
                rows[: n - 1] = self.rows[: n - 1] if len(self.rows) else [self._row(t.tokens) for t in self.templates[:-1]]
                self.rows = rows
            self.rows[n - 1] = self._row(template.tokens)


class TemplateTree:
    """A prefix tree of fixed depth: number of tokens, the first ``depth`` and the last one, then the templates of a leaf."""

    def __init__(self, depth: int = DEPTH, similarity: float = SIMILARITY):
        self.depth, self.similarity = depth, similarity
        self.leaves: dict[tuple, Leaf] = {}

    def path(self, tokens: list[str]) -> tuple:
        return (len(tokens), *tokens[: self.depth], *tokens[-1:])

    def add(self, masked: str, times: int = 1) -> Template:
        """The template that a message joins: the first of its leaf with enough equal tokens, else a new one."""
        tokens = _TOKEN.findall(masked)
        path = self.path(tokens)
        if (leaf := self.leaves.get(path)) is None:
            leaf = self.leaves[path] = Leaf()
        found = leaf.find(tokens, self.similarity * len(tokens))
        if found is None:
            found = Template(masked, tokens)
            leaf.append(found)
        found.join(tokens, times)
        return found

    def templates(self) -> list[tuple[str, int]]:
        return [(" ".join(t.shown), t.messages) for leaf in self.leaves.values() for t in leaf.templates]


def template_kind(message: str) -> str | None:
    """``filler``, ``script`` or ``error`` for a message of a template; None for ordinary text and for reports."""
    if _is_latin_filler(message) or _is_repeated(message):
        return "filler"
    if not _SIGN.search(message):
        return None
    if FILLER.search(message):
        return "filler"
    for pattern, kind in ((SCRIPTS, "script"), (ERRORS, "error")):
        if pattern.search(message):
            return None if REPORTS.search(message) else kind
    return None


def slot_kind(message: str) -> str | None:
    """``slot`` or ``unset`` for a message with a slot or value that wasn't filled in."""
    return "slot" if SLOTS.search(message) else "unset" if UNSET.search(message) else None


def classify(message: str) -> str | None:
    """``slot``, ``unset``, ``filler``, ``error`` or ``script`` for a single message; None for ordinary text."""
    return slot_kind(message) or template_kind(message)


class Inspector:
    """Verdicts of single messages, each a template of its own, where no corpus is at hand; ``remember`` bounds the memory only."""

    def __init__(self, remember: int = 200_000):
        self.remember, self.verdicts = remember, {}

    def messages(self, content: str | None) -> list[tuple[str, str]]:
        """(masked message, kind) of all messages of a content that are residue."""
        if not content:
            return []
        content = spelled(content)
        cued = any(map(content.__contains__, _CUES))
        out = []
        for message in _BREAK.split(content):
            message = message.strip()
            if message and (cued and any(map(message.__contains__, _CUES)) or _is_repeated(message) or _is_latin_filler(message)):
                if message not in self.verdicts:
                    if len(self.verdicts) >= self.remember:
                        self.verdicts.clear()
                    self.verdicts[message] = classify(message)
                if self.verdicts[message]:
                    out.append((mask(message), self.verdicts[message]))
        return out

    def kinds(self, content: str | None) -> list[str]:
        """All kinds of residue in a content, sorted; empty for null, empty and clean contents."""
        return sorted({kind for _, kind in self.messages(content)})


def _is_repeated(message: str) -> bool:
    """Whether a message is one short unit over and over."""
    return len(message.strip()) >= 8 and bool(_REPEATED.match(message))


def _is_latin_filler(message: str) -> bool:
    words = _LATIN.findall(message)
    return len(words) > 3 and 2 * sum(map(len, words)) > len(message) and sum(w.lower() in _LATIN_FILLER for w in words) > 0.6 * len(words)


_INSPECTOR: list[Inspector] = []


def inspector() -> Inspector:
    if not _INSPECTOR:
        _INSPECTOR.append(Inspector())
    return _INSPECTOR[0]


def _messages(spelled_content: str) -> list[str]:
    """The masked messages of a spelled content."""
    return [m for part in _BREAK.split(masked(spelled_content)) if (m := " ".join(part.split()))]


def _count_messages(batches):
    """(leaf, message, n): partial counts of the masked messages with the hash of their leaf."""
    tree, held = TemplateTree(), Counter()

    def out():
        messages, n = list(held), list(held.values())
        leaves = [xxhash.xxh64_intdigest("\x1f".join(map(str, tree.path(_TOKEN.findall(m)))).encode("utf-8", "surrogatepass")) - (1 << 63) for m in messages]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64()), pa.array([m.encode("utf-8", "replace").decode() for m in messages]), pa.array(n, pa.int64())], names=["leaf", "message", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                held.update(_messages(spelled(text)))
        if len(held) > _HELD:
            yield out()
    if held:
        yield out()


def _mine(batches):
    """(leaf, message, n, at, kind, template) of the messages of templates with a verdict, from messages by leaf and frequency.

    Only the templates of one leaf are held at a time, the messages pass by. A template's form with wildcards comes
    with its first message, ``at`` tells the templates of a leaf apart.
    """
    leaf, tree, rows = None, None, []

    def out():
        columns = list(zip(*rows))
        rows.clear()
        types = (pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], names=["leaf", "message", "n", "at", "kind", "first"])

    for batch in batches:
        for new, message, n in zip(*(c.to_pylist() for c in batch.columns)):
            if new != leaf:
                leaf, tree = new, TemplateTree()
            found = tree.add(message, n)
            if found.kind:
                rows.append((leaf, message, n, zlib.crc32(found.first.encode()) & 0x7FFFFFFF, found.kind, found.first))
        if len(rows) > _HELD:
            yield out()
    if rows:
        yield out()


def mined(df: DataFrame, content: str = "content") -> DataFrame:
    """(leaf, message, n, at, kind, first): the masked messages of the templates with a verdict, mined from all contents.

    Messages are counted in the tasks and summed before they meet in their leaf, so copies of a page are one row
    there. ``first`` is the message by which a template was classified; (leaf, at) names the template.
    """
    ship(df.sparkSession)
    counted = spread(df.select(content)).mapInArrow(_count_messages, "leaf long, message string, n long")
    counted = counted.repartition("leaf").groupBy("leaf", "message").agg(F.sum("n").alias("n"))
    return checkpointed(counted.sortWithinPartitions("leaf", F.desc("n"), "message").mapInArrow(_mine, "leaf long, message string, n long, at int, kind string, first string"))


def templates(df: DataFrame, content: str = "content") -> DataFrame:
    """(template, kind, messages, forms): the templates with a verdict, by their most frequent message, how many messages
    they have and in how many forms. An empty table gives an empty result."""
    found = mined(df, content).groupBy("leaf", "at", "first", "kind").agg(F.sum("n").alias("messages"), F.count("*").alias("forms"))
    return found.select(F.col("first").alias("template"), "kind", "messages", "forms")


def _hash(message: str) -> int:
    """What the built-in xxhash64 gives."""
    h = xxhash.xxh64_intdigest(message.encode("utf-8", "replace"), 42)
    return h - (1 << 64) if h >> 63 else h


_SLOT_CUES = _literals(SLOTS, UNSET)


def _slots(text: str) -> set[str]:
    """Kinds of slots and unset values in the messages of a spelled content."""
    if not any(map(text.__contains__, _SLOT_CUES)):
        return set()
    return {kind for m in _BREAK.split(text) if (kind := slot_kind(m.strip()))}


def residue(df: DataFrame, key: str = "id", content: str = "content", found: DataFrame | None = None) -> DataFrame:
    """(key, kinds) of the rows whose content holds residue; ``kinds`` is a sorted array of what was found.

    ``found`` is the result of :func:`mined` on the corpus that the rows are from, else it is made of ``df``. Null,
    empty and blank contents give no row, repeated rows repeated results; whole contents are read, however long; an
    empty table gives an empty result; other columns don't matter. Where at most ``SENT`` messages have a verdict
    they are sent to every task, 8 bytes each; beyond that the messages of all contents are joined with them.
    """
    spark = df.sparkSession
    ship(spark)
    found = mined(df, content) if found is None else found
    kind_of = found.select("message", "kind").distinct()
    few = kind_of.limit(SENT + 1).count() <= SENT
    rows = spread(df.select(key, content), key)
    type_ = df.schema[key].dataType.simpleString()
    if few:
        sent = spark.sparkContext.broadcast({r.h: r.kind for r in kind_of.select(F.xxhash64("message").alias("h"), "kind").collect()})

        def run(batches):
            for batch in batches:
                out = []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    if text:
                        text = spelled(text)
                        if kinds := {k for m in _messages(text) if (k := sent.value.get(_hash(m)))} | _slots(text):
                            out.append((i, sorted(kinds)))
                if out:
                    at, kinds = zip(*out)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(kinds, pa.list_(pa.string()))], names=["key", "kinds"])

        return rows.mapInArrow(run, f"key {type_}, kinds array<string>").withColumnRenamed("key", key)

    def spell(batches):
        for batch in batches:
            texts = [spelled(t or "") for t in batch.column(1).to_pylist()]
            messages = [[m.encode("utf-8", "replace").decode() for m in _messages(t)] for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(messages, pa.list_(pa.string())), pa.array([sorted(_slots(t)) for t in texts], pa.list_(pa.string()))], names=["key", "messages", "slots"])

    said = rows.mapInArrow(spell, f"key {type_}, messages array<string>, slots array<string>")
    by_template = said.select("key", F.explode("messages").alias("message")).join(kind_of, "message").select("key", "kind")
    every = by_template.unionAll(said.select("key", F.explode("slots").alias("kind")))
    return every.groupBy("key").agg(F.sort_array(F.collect_set("kind")).alias("kinds")).withColumnRenamed("key", key)


def residue_alone(df: DataFrame, key: str = "id", content: str = "content") -> DataFrame:
    """(key, kinds) as :func:`residue` has it for rows whose corpus isn't at hand: each message is its own template. Map only."""
    ship(df.sparkSession)

    def run(batches):
        judge = inspector()
        for batch in batches:
            out = [(i, kinds) for i, text in enumerate(batch.column(1).to_pylist()) if text and (kinds := judge.kinds(text))]
            if out:
                at, kinds = zip(*out)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(kinds, pa.list_(pa.string()))], names=["key", "kinds"])

    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(key, content), key).mapInArrow(run, f"key {kind}, kinds array<string>").withColumnRenamed("key", key)
