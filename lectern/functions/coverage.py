"""Facts that a merged text must keep: numbered items, bold terms, names, numbers, and muscles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.predicates import EDGE
from lectern.functions.text import HAN, WS, nfkc, paragraphs, trimmed

FAMILIES = ("numbered", "bold", "names", "numbers", "muscles")
_TAIL = rf"[\s\x{{3000}}。．.；;，,、：:！!？?]+$"
#: Tokens that are headings of no content.
STOP = ("参考书目", "索引", "小结", "Contents")


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _clean(items: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(items, trimmed), lambda x: x != ""))


#: Characters that no name ends with, none that a muscle's name begins with, and none within it.
NAME_ENDS, MUSCLE_STARTS, MUSCLE_HOLDS = "提认说的在是了与和及", "与和及的将把被块组造成两令这发只由容", "块组造成两令这发只由的主导"


def _compounds(spans: Column) -> Column:
    """Items of catalogues of compounds that share a last word, with conjunctions and punctuation taken off."""
    pieces = F.flatten(F.transform(spans, lambda x: F.split(x, "[、，,;；和与及]")))
    bare = F.transform(pieces, lambda x: F.regexp_replace(F.regexp_replace(trimmed(x), "^(?:和|与|及|以及|、)+", ""), _TAIL, ""))
    return F.filter(bare, lambda x: x.rlike(f"^[{HAN}]{{2,8}}出汗$"))


# The patterns of the families are fixed values of the task.
def token_families(text: Column) -> Column:
    """``struct`` of five arrays of distinct tokens in the order of the text."""
    text = F.regexp_replace(text, r"(?s)\*\[Figure omitted from source conversion:.*?\]\*", "")
    items = _all(text, rf"(?md)^{WS}*(?:\p{{Nd}}+[.、]|[一二三四五六七八九十]+、){WS}*(.+)$", 1)
    # an item's length counts its punctuation, which is then taken off
    short = F.filter(F.transform(items, trimmed), lambda x: F.length(x) <= 12)
    numbered = F.transform(short, lambda x: F.regexp_replace(x, _TAIL, ""))
    names = F.concat(
        _all(text, rf"{EDGE[0]}(?:METT|FACS|AU\p{{Nd}}+){EDGE[1]}"),
        _all(text, r"[A-Z][A-Za-z]+(?:[ -][A-Z][A-Za-z]+)*"),
        F.transform(_all(text, f"[{HAN}]{{1,4}}·[{HAN}]{{1,4}}"), lambda x: F.regexp_replace(x, f"[{NAME_ENDS}]+$", "")),
    )
    numbers = F.concat(
        _all(text, r"\p{Nd}+%"), _all(text, rf"\p{{Nd}}+{WS}*/{WS}*\p{{Nd}}+"), _all(text, r"(?<![.\p{Nd}])0\.\p{Nd}+"),
        _all(text, r"(?<![.\p{Nd}])\p{Nd}{2,}(?![.\p{Nd}])"), _all(text, r"\p{Nd}+(?:秒|分钟|小时|毫秒|次|种|个|条|项|章|节)"),
    )
    muscles = F.concat(
        F.transform(_all(text, f"[{HAN}]{{1,4}}肌"), lambda x: F.regexp_extract(x, f"([{HAN}&&[^{MUSCLE_STARTS}{MUSCLE_HOLDS}]][{HAN}&&[^{MUSCLE_HOLDS}]]{{0,3}}肌)$", 1)), _all(text, r"AU\p{Nd}+")
    )
    bold = F.filter(_all(text, r"\*\*(.+?)\*\*", 1), lambda x: F.length(trimmed(x)) >= 2)
    families = (F.concat(numbered, _compounds(numbered), _compounds(F.concat(F.array(text), paragraphs(text), F.split(text, "[。．]")))), bold, names, numbers, muscles)
    return F.struct(*(_clean(x).alias(name) for name, x in zip(FAMILIES, families, strict=True)))


def flat_tokens(families: Column) -> Column:
    """All tokens in the order of the families: NFKC, trimmed, without outline numbers and stop words, distinct."""
    mark = "\x02"
    joined = F.array_join(F.concat(*(families[name] for name in FAMILIES)), mark)
    bare = F.transform(F.split(nfkc(joined), mark), lambda x: F.regexp_replace(x, r"^[\s：:;；。、,.]+|[\s：:;；。、,.]+$", ""))
    return F.array_distinct(F.filter(bare, lambda x: (x != "") & ~x.rlike(r"^[1-9]\p{Nd}{0,2}(?:\.\p{Nd}{1,3})+$") & ~x.isin(*STOP)))


def missing_tokens(output: Column, required: Column, convert: tuple[str, str] = ("", "")) -> Column:
    """Required tokens that the output doesn't hold, neither as they are nor with the characters of ``convert`` replaced in both."""
    swap = lambda c: F.translate(c, *convert) if convert[0] else c
    # a Python function can't stand in a lambda, so the normalized output goes in beside each token
    hay = F.array_repeat(nfkc(output), F.size(required))
    absent = F.zip_with(required, hay, lambda t, h: F.when(~(F.contains(h, t) | F.contains(swap(h), swap(t))), t))
    return F.filter(absent, lambda t: t.isNotNull())
