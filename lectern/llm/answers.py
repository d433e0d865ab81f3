"""Defects of prompt and response pairs: empty, copied, refusal, truncated, other_language.

The text decides, never the finish reason or the token counts. Copies are
found by greedy string tiling, refusals by a grammar over sentences, breaks by
a pushdown parser over fences, brackets, quotations, lists, tables and JSON,
and languages by scripts and function words.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKER = "---CONFLICTS-JSON---"
_HIDDEN = re.compile("[\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff\ufe00-\ufe0f]")
_FENCE = re.compile(r"^[ \t]*(```+|~~~+)[^\n`]*$", re.M)
_TAG = re.compile(r"<[/!]?[A-Za-z][^<>\n]*>|<!--.*?-->|&(?:nbsp|zwnj|#\d+);", re.S)
_APART = re.compile(r"[\W_]+")
#: A line that only announces the answer: a heading, or a short line that ends with a colon.
_LEAD = re.compile(r"\s*(?:#{1,6}[ \t]*[^\n]*|(?:\*\*)?[^\n。！？.!?|{}\[\]]+[:：](?:\*\*)?)[ \t]*(?=\n|$)")
#: Words that stand for nothing.
NOTHING = {"null", "none", "nil", "na", "nan", "undefined", "empty", "无", "無", "空", "无内容", "無內容"}


def _plain(text: str) -> str:
    return _APART.sub("", unicodedata.normalize("NFKC", _HIDDEN.sub("", text))).lower()


def _without_lead(text: str) -> str:
    """The answer without the lines that announce it; whole headed texts keep what follows."""
    for _ in range(3):
        match = _LEAD.match(text)
        if not match or not match.group().strip():
            break
        text = text[match.end() :]
    return text


def _body(text: str) -> str:
    """The answer without its trailing conflict list."""
    return text.partition(MARKER)[0]


# --- empty ---------------------------------------------------------------------------------------


def is_empty(text: str | None) -> bool:
    """Nothing but white space, invisible characters, markup, or markers that stand for nothing."""
    if not text:
        return True
    head, mark, tail = text.partition(MARKER)
    if mark and _plain(tail):
        return False
    rest = _TAG.sub(" ", _without_lead(_FENCE.sub("", head)))
    word = _plain(rest)
    if word in NOTHING:
        return True
    if word:
        return False
    return not any(unicodedata.category(c) == "So" for c in rest)


# --- copied --------------------------------------------------------------------------------------


def tiles(a: str, b: str, least: int = 12, band: int | None = None) -> list[tuple[int, int, int]]:
    """Greedy string tiling: common stretches ``(start in a, start in b, length)`` that don't overlap, the longest of all first, ties from the left of ``a`` and then of ``b``; with ``band``, only those whose starts are that close."""
    seeds: dict[str, list[int]] = {}
    for j in range(len(b) - least + 1):
        seeds.setdefault(b[j : j + least], []).append(j)
    heap: list[tuple[int, int, int]] = []
    for i in range(len(a) - least + 1):
        found = seeds.get(a[i : i + least], [])
        if band is not None:
            found = found[bisect_left(found, i - band) : bisect_right(found, i + band)]
        for j in found:
            if i and j and a[i - 1] == b[j - 1] and (band is None or abs(j - i) <= band):
                continue  # the stretch begins further left
            n = least
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            heap.append((-n, i, j))
    heapq.heapify(heap)
    in_a, in_b = bytearray(len(a)), bytearray(len(b))
    out = []
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        if not any(in_a[i : i + n]) and not any(in_b[j : j + n]):
            out.append((i, j, n))
            in_a[i : i + n] = in_b[j : j + n] = b"\1" * n
            continue
        # what tiles have left of the stretch, each part by its own length
        begun = None
        for k in range(n + 1):
            if k < n and not in_a[i + k] and not in_b[j + k]:
                begun = k if begun is None else begun
            elif begun is not None:
                if k - begun >= least:
                    heapq.heappush(heap, (begun - k, i + begun, j + begun))
                begun = None
    return sorted(out)


def _passages(prompt: str) -> list[str]:
    """The prompt, and what follows its instruction: one or two opening lines, or all up to a line that ends with a colon, while they are the shorter part."""
    found, at = [prompt], 0
    for number, line in enumerate(prompt.strip("\n").split("\n")):
        at += len(line) + 1
        rest = prompt.strip("\n")[at:]
        if len(rest) < at:
            break
        if number < 2 or line.rstrip().endswith((":", "：")):
            found.append(rest)
    return found


def is_copied(text: str, prompt: str | None) -> bool:
    """The answer is the prompt or its passage, or four fifths of it from its start, with nothing of its own."""
    if not prompt:
        return False
    body = _body(text)
    own = _END.sub("", _FENCE.sub("", body).rstrip())
    passages = [p for p in dict.fromkeys(map(_plain, _passages(prompt))) if p]
    for answer in {_plain(x) for x in (body, own, _without_lead(own))}:
        for passage in passages:
            # what comes before the passage's first words is a lead-in on the same line, if it is a small part
            copy = answer[max(answer.find(passage[:16], 0, len(answer) // 5 + 16), 0) :]
            if not copy or not 0.8 * len(passage) <= len(copy) <= len(passage) + 2:
                continue
            if passage.startswith(copy):
                return True
            # nothing of its own, and from the start: all of the answer in place, but for a slip at a seam
            if sum(n for *_, n in tiles(copy, passage, band=len(copy) // 50 + 2)) >= 0.98 * len(copy):
                return True
    return False


# --- refusal -------------------------------------------------------------------------------------

_QUOTED = re.compile(r"“[^”]*”|「[^」]*」|『[^』]*』|‘[^’\n]*’|《[^》]*》|\"[^\"\n]*\"")
_SENTENCE = re.compile(r"[^。！？!?\n]+?(?:[。！？!?\n]+|(?<=[a-z\)])\.(?:\s+|$)|$)|[^。！？!?\n]+$", re.M)
_APOLOGY = re.compile(
    r"抱歉|对不起|對不起|不好意思|遗憾|遺憾|唔好意思|對唔住|对唔住|请原谅|請原諒|见谅|見諒|\b(?:sorry|apolog\w+|regret\w*|unfortunately|forgive me)\b|désolé|regrette|malheureusement|lo siento|lamento|leider|tut mir leid|entschuldig|mi dispiace|desculpe|申し訳|すみません|ごめん|죄송|извин|к сожалению",
    re.I,
)
#: What fills the slots of the grammar of declining.
_SLOTS = {
    "unable": "无法|無法|不能|不便|不会|不會|不可以|没有办法|沒有辦法|没办法|沒辦法|暂不支持|暫不支持|不支持|选择不|選擇不|拒绝|拒絕|婉拒|不予|不提供|不打算|难以|難以|不方便|恕不|冇辦法|冇办法|唔方便|唔可以|唔能夠|唔會|唔能|唔提供|幫唔到|帮不了|做不到|做唔到",
    "task": "协助|協助|帮|幫|翻译|翻譯|译|譯|继续|繼續|完成|处理|處理|提供|回答|答|合并|合併|改写|改寫|输出|輸出|给出|給出|总结|總結|满足|滿足|执行|執行|写|寫|生成|讨论|討論|回应|回應|答复|答覆|处置|整理|摘要|归纳|歸納|請求|请求|这个|呢個",
    "near": r"[^，。！？,\n]{0,14}?",
    "cannot": r"can(?:'|’)?t|cannot|can not|couldn(?:'|’)?t|won(?:'|’)?t|will not|(?:un|not )able to|not in a position to|not going to|not (?:permitted|allowed) to|prefer not to|rather not|(?:isn(?:'|’)?t|not) possible (?:for me )?to",
    "decline": "decline|refuse|pass on",
    "must": "must|have to|need to|choose to|will",
    "ease": r"(?:don(?:'|’)t feel|not) comfortable",
    "be": "is|are|be|been|was",
    "refused": "declined|refused|not supported|not permitted|not allowed|not possible|beyond",
    "rules": "policy|policies|guidelines|rules",
    "result": r"translation|answer|summary|merge|merged \w+|text|output|reply|response|outline|rewrite",
    "abroad": "ne (?:peux|puis|suis) pas|ne pouvons pas|impossible de|no puedo|no podemos|kann (?:ich )?(?:leider )?nicht|kann das nicht|non posso|não posso|できません|いたしかねます|お断り|お手伝いでき|할 수 없|도와드릴 수|не могу|не можем",
}
#: The rules of the grammar: a slot's name in angle brackets stands for any of its fillers.
_RULES = (
    "<unable><near><task>", r"\b<cannot>\b", r"\b<must> <decline>\b", r"\b<decline> to\b", r"\b<ease>\b", r"\b<be> <refused>\b", r"\bgoes against\b", r"\bagainst (?:the |my |our )?<rules>\b",
    r"\bno <result> (?:will|can|is)\b", r"\bnothing further will be\b", r"\b(?:outside|beyond) (?:my|the) (?:scope|ability|abilities)\b", "<abroad>",
)
_DECLINE = re.compile("|".join(re.sub("<([a-z]+)>", lambda m: f"(?:{_SLOTS[m.group(1)]})", rule) for rule in _RULES), re.I)
_AGENT = re.compile(
    r"我|本助手|本系统|本系統|这里|這裡|呢度|作为(?:一个)?(?:语言)?模型|作為(?:一個)?(?:語言)?模型|作為|根据使用规范|根據使用規範|出于安全|出於安全|这类请求|這類請求|此类|恕|目前|暂|\b(?:i|i'm|i’m|we|my|as an? (?:ai|language model|assistant))\b|\b(?:this|that|the) (?:request|task|passage|content|text|material|message|document|input|prompt)\b|\bnothing further\b|\bno (?:translation|answer|summary)|je |nous |yo |ich |io |eu |私|저|я ",
    re.I,
)
_COURTESY = re.compile(
    r"请换一个话题|請換一個話題|换一个|換一個|如果您有|如果你有|如有其他|敬请谅解|敬請諒解|多謝體諒|多谢体谅|谢谢|感谢|很乐意帮忙|樂意幫忙|超出了我的能力|涉及他人隐私|請咨詢|请咨询|请联系|專業人士|专业人士|请尝试|其他问题|其他問題|please (?:try|consult|contact|ask|choose|see)|try something else|thanks? (?:for|you)|happy to help|let me know|hope you understand|identify a person|consult a",
    re.I,
)


def _strings(value: object) -> Iterator[str]:
    if isinstance(value, str):
        yield value
    elif isinstance(value, dict):
        for x in value.values():
            yield from _strings(x)
    elif isinstance(value, list):
        for x in value:
            yield from _strings(x)


def _spoken(text: str) -> str:
    """What an answer says: the strings of a small JSON object, else the text."""
    bare = _FENCE.sub("", text).strip()
    if bare[:1] in "{[\"":
        try:
            value = json.loads(bare)
        except ValueError:
            return text
        if isinstance(value, str) or (isinstance(value, dict) and len(value) <= 3 and set(value) & {"error", "message", "note", "refusal", "reason", "detail", "warning", "answer", "response", "text", "status", "content", "result", "output", "reply"}):
            return "\n".join(_strings(value))
    return text


def is_refusal(text: str) -> bool:
    """Declines the task: its sentences, quotations aside, refuse, apologize or are courtesies, and little else is said."""
    said = _QUOTED.sub("", _without_lead(_body(_spoken(text))) or _spoken(text))
    refused = other = courtesy = 0
    first = None
    for match in _SENTENCE.finditer(said):
        sentence = match.group().strip()
        size = len(_plain(sentence))
        if not size:
            continue
        declines = bool(_DECLINE.search(sentence)) and bool(_AGENT.search(sentence) or _APOLOGY.search(sentence))
        if declines:
            refused += size
        elif _APOLOGY.search(sentence) or _COURTESY.search(sentence):
            courtesy += size
        else:
            other += size
        if first is None:
            first = declines or bool(_APOLOGY.search(sentence)) or bool(_COURTESY.search(sentence))
    return bool(first) and refused > 0 and other <= 0.5 * (refused + courtesy)


# --- truncated -----------------------------------------------------------------------------------

_PAIRS = {"(": ")", "[": "]", "{": "}", "（": "）", "［": "］", "｛": "｝", "【": "】", "《": "》", "〈": "〉", "「": "」", "『": "』", "“": "”", "〔": "〕", "«": "»"}
_CLOSERS = set(_PAIRS.values())
_BRACKETS = re.compile("[" + "".join(map(re.escape, [*_PAIRS, *_PAIRS.values()])) + "]")
_EMOJI = "\u2600-\u27bf\U0001f000-\U0001faff\ufe0f\u200d"
#: Endings that are complete though no sentence ends there: a tag, a node's name, a sign-off, a closing remark, an emoji.
_END = re.compile(
    rf"\n[ \t]*(?:\[[\w.#:-]+\]|[*_]+[\w.:# -]+[*_]+|[—–-]+ ?(?:整理自|整理|摘自|编者|編者|collected by|compiled by|edited by|translated by|by |signed|source)[^\n]*|——? ?[^\n。！？]{{1,24}}|[(（](?:完|全文完|本节完|本節完|end[^()（）\n]*|fin)[)）]|[{_EMOJI}]+)[ \t]*$",
    re.I,
)
_COMPLETE = re.compile(rf"(?:[。！？!?…]|(?<!\d)\.|\.\.\.)[”’」』）)\]\"'*_》]*$|[{_EMOJI}]+$")
_DANGLING = re.compile(r"^\s*(?:[-*+•]|\d+[.)、]|[A-Da-d][.)、]|[（(][一二三四五六七八九十\d]+[)）])\s*$")
_ITEM = re.compile(r"^\s*(?:[-*+•]|\d+[.)、]|[A-Z][.)、]|[（(][一二三四五六七八九十\d]+[)）])\s+\S")


def open_structures(text: str) -> list[str]:
    """The closers that a pushdown parser still expects at the end of ``text``."""
    stack: list[str] = []
    fence = None
    for line in text.split("\n"):
        mark = re.match(r"\s*(```+|~~~+)", line)
        if mark:
            if fence is None:
                fence = mark.group(1)
            elif line.strip().startswith(fence[:3]):
                fence = None
            continue
        if fence is not None:
            continue
        line = re.sub(r"^\s*(?:[A-Za-z]|\d+)[)）]\s", "", line)
        if line.count('"') % 2 and '"' not in stack:
            opened = line.rfind('"')
            if len(line) - opened - 1 > 0 or not _COMPLETE.search(line):
                stack.append('"')
        for c in _BRACKETS.findall(line):
            if c in _PAIRS:
                stack.append(_PAIRS[c])
            elif c in _CLOSERS and c in stack:
                while stack.pop() != c:
                    pass
    return ([fence] if fence is not None else []) + stack


def _json_broken(text: str) -> bool:
    try:
        json.loads(text)
    except ValueError:
        return True
    return False


def is_truncated(text: str) -> bool:
    """Breaks off inside a sentence, number, quotation, bracket, list, table, JSON value or fenced block."""
    text = _HIDDEN.sub("", text).rstrip() if not text.rstrip().endswith("‍") else text.rstrip()
    if len(_FENCE.findall(text)) % 2:
        return True
    bare = _FENCE.sub("", text).strip()
    if bare[:1] in "{[" and not re.match(r"\[[\w.#:-]+\]\s*\n|\[[^\]\n\"{]*\]", bare):
        return _json_broken(bare)
    head, mark, tail = text.partition(MARKER)
    if mark:
        tail = _FENCE.sub("", tail).strip()
        return _json_broken(tail) if tail else False
    text = head.rstrip()
    if re.search(r"\n-{2,}[A-Z-]*$", text) and MARKER.startswith(text.rpartition("\n")[2]):
        return True
    if text.endswith("```"):
        return bool(open_structures(text))
    last = text.rpartition("\n")[2].strip()
    if last.startswith("|"):
        return not last.endswith("|") or len(last) < 3
    if _DANGLING.match(last):
        return True
    ended = _END.search(text)
    if ended:
        return bool(open_structures(text[: ended.start()]))
    if open_structures(text):
        return True
    if _COMPLETE.search(text):
        return False
    lines = [x for x in text.split("\n") if x.strip()]
    if re.match(r"#{1,6} ", last):
        return len(lines) > 1
    items = [x for x in lines if _ITEM.match(x)]
    if _ITEM.match(last) and len(items) > 2:  # lists of mere words have no full stops
        return sum(not _COMPLETE.search(x.rstrip()) for x in items) <= len(items) / 2
    return True


# --- other language ------------------------------------------------------------------------------

_HAN = re.compile("[\u3400-\u9fff\u8c48-\ufaff\U00020000-\U0003ffff]")
_LATIN = re.compile("[A-Za-z\u00c0-\u024f]")
_KANA = re.compile("[\u3040-\u30ff\u31f0-\u31ff\uff66-\uff9d]")
_FOREIGN = re.compile("[\u0400-\u04ff\u0370-\u03ff\u0590-\u06ff\u0900-\u097f\u0e00-\u0e7f\uac00-\ud7af\u1100-\u11ff]")
_YUE = re.compile("[嘅喺唔佢哋咗啲嗰冇嚟噉㗎咁乜嘢睇吓俾畀仲咪嘥攞揾諗嘞喎啦嗱啱嘢]|係")
_MANDARIN = re.compile("[的是这這那们們没沒了在把被她它很吗嗎吧呢]|不")
#: Frequent function words of English and of other languages in Latin letters.
ENGLISH = {"the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "was", "on", "with", "as", "at", "by", "not", "be", "this", "from", "or", "which", "an", "are", "when", "one", "before", "while", "because", "had", "has", "than", "but", "you", "your", "they", "who"}
OTHERS = {"le", "la", "les", "des", "du", "de", "et", "un", "une", "que", "qui", "dans", "pour", "sur", "est", "pas", "puis", "avec", "ne", "il", "elle", "au", "aux", "ou", "el", "los", "las", "y", "en", "con", "por", "para", "una", "se", "der", "die", "das", "und", "ist", "nicht", "ein", "eine", "mit", "den", "dem", "zu", "auf", "von", "im", "il", "lo", "gli", "che", "di", "per", "non", "sono", "o", "os", "as", "uma", "não", "com", "em", "avant", "sans", "jamais", "d", "l", "qu", "c"}


def language_of(text: str) -> str:
    """zh, yue, en, or other; the empty string if there is too little to tell. Quotations, tags and tables don't count."""
    lines = [x for x in _without_lead(_body(_FENCE.sub("", text))).split("\n") if not x.lstrip().startswith(("|", "#"))]
    said = _END.sub("", "\n" + "\n".join(lines))
    bare = _QUOTED.sub("", said)
    # an answer that is all quotation is judged by it
    if len(_plain(bare)) < 0.34 * len(_plain(said)):
        bare = said
    han, latin, kana, foreign = (len(x.findall(bare)) for x in (_HAN, _LATIN, _KANA, _FOREIGN))
    if han + latin + kana + foreign < 4:
        return ""
    if kana > 0.15 * (han + kana) and kana > 5:
        return "other"
    if foreign > 0.4 * (han + latin + foreign):
        return "other"
    if han * 3 >= latin:  # a Han character says as much as several letters
        yue, mandarin = len(_YUE.findall(bare)), len(_MANDARIN.findall(bare))
        return "yue" if yue > mandarin else "zh"
    words = re.findall(r"[a-zà-ɏ]+", bare.lower())
    english, others = sum(w in ENGLISH for w in words), sum(w in OTHERS for w in words)
    return "other" if others > english else "en"


def defect_of(text: str | None, prompt: str | None, reply_lang: str | None) -> str | None:
    """The first defect that fits, or null for a sound answer; a null reply language demands none."""
    if is_empty(text):
        return "empty"
    if is_copied(text, prompt):
        return "copied"
    if is_refusal(text):
        return "refusal"
    if is_truncated(text):
        return "truncated"
    if reply_lang and (found := language_of(text)) and found != reply_lang.strip().lower():
        return "other_language"
    return None


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, texts, prompts, langs = (batch.column(i).to_pylist() for i in range(4))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([defect_of(*x) for x in zip(texts, prompts, langs, strict=True)], pa.string())], names=["cache_key", "defect"])


def defective_answers(cache: DataFrame, calls: DataFrame) -> DataFrame:
    """``(cache_key, defect)`` of every defective answer.

    Repeated rows of a key count once; a null key is none. An answer without a call has no prompt
    that it could copy and no language to be in; a call without an answer is no
    row. Null answers are empty. Extra columns are ignored.
    """
    prompts = calls.select("cache_key", "user_text", "reply_lang").dropDuplicates(["cache_key"])
    answers = cache.where(F.col("cache_key").isNotNull()).select("cache_key", "response_text").dropDuplicates(["cache_key"])
    rows = answers.join(prompts, "cache_key", "left").select("cache_key", "response_text", "user_text", "reply_lang")
    return rows.mapInArrow(_judged, "cache_key string, defect string").where(F.col("defect").isNotNull())
