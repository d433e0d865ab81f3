"""Predicates on headings, lines and paragraphs of scanned books. The word lists are fixed values of the task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.text import HAN, WS, compact_key, normalize_title, trimmed, visible_line

#: Compact keys and words that mark front and back matter.
TOC_KEYS = ("目录", "总目录", "contents", "微表情相关章节目录")
PREFACE_WORDS = ("前言", "序言", "导读", "引言")
COPYRIGHT_KEYS = ("版权信息", "cip")
BIBLIOGRAPHY_WORDS = ("参考书目", "索引")
SKILL_TEST = "表情辨识能力测试|普通表情的辨识|常见表情的辨识|复杂表情的辨识|表情的辨识"
SALES = "权威之作|职场达人|谈判高手|管理大师|恋爱专家|无论你是销售员还是管理者"
CUES = "名言|说过|指出|提出|理论|定律|规则|研究表明"
CHAPTER = "^【?第[0-9零○〇一二三四五六七八九十百千两]+章"
SECTION = "^【?第[0-9零○〇一二三四五六七八九十百千两]+节"
LIST_ITEM = rf"^{WS}*(?:[-*+]|[0-9]+[.)、]|[一二三四五六七八九十]+、){WS}+.*\S"
#: Java's \b takes ideographs for no word characters on some versions; this form means the same everywhere.
EDGE = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def is_rule(line: Column) -> Column:
    return line.rlike(rf"^{WS}*(?:-{{3,}}|\*{{3,}}|_{{3,}}){WS}*$")


def is_contents_heading(title: Column, stable: bool = True) -> Column:
    return compact_key(title, stable).isin(*TOC_KEYS)


def is_preface_heading(title: Column, stable: bool = True) -> Column:
    head = F.substring(F.translate(normalize_title(title, stable), " ", ""), 1, 6)
    return (compact_key(title, stable) == "preface") | head.rlike("|".join(PREFACE_WORDS))


def is_bibliography_heading(title: Column, stable: bool = True) -> Column:
    return compact_key(title, stable).rlike("^(?:" + "|".join(BIBLIOGRAPHY_WORDS) + ")")


def is_publisher_note(title: Column, stable: bool = True) -> Column:
    return compact_key(title, stable).startswith("出版说明")


def is_copyright_heading(title: Column, stable: bool = True) -> Column:
    key = compact_key(title, stable)
    return key.isin(*COPYRIGHT_KEYS) | key.contains("图书在版编目") | key.startswith("cip")


def is_cover(title: Column, stable: bool = True) -> Column:
    return compact_key(title, stable) == "封面"


def is_afterword(title: Column, stable: bool = True) -> Column:
    return compact_key(title, stable).contains("后记")


def returns_to_contents(line: Column) -> Column:
    return visible_line(line) == "返回总目录"


def returns_to_contents_alone(line: Column) -> Column:
    return returns_to_contents(line) & ~line.rlike(LIST_ITEM)


def is_metadata_line(line: Column) -> Column:
    return line.rlike(rf"(?i:ISBN)|版权所有|图书在版编目|责任编辑|责任印制|出版发行|中国版本图书馆|{EDGE[0]}CIP{EDGE[1]}|\*\*[^*]{{1,12}}：\*\*")


def has_prose(lines: Column, least: int = 40) -> Column:
    """True if the lines that are no list items, metadata or rules have so many characters."""
    kept = F.filter(lines, lambda x: (trimmed(x) != "") & ~is_rule(x) & ~x.rlike(LIST_ITEM) & ~is_metadata_line(x))
    return F.aggregate(kept, F.lit(0), lambda n, x: n + F.length(trimmed(x))) >= least


def is_imprint_text(text: Column) -> Column:
    """A cataloguing block, or an ISBN with rights, editors or printers."""
    return text.rlike(rf"{EDGE[0]}CIP{EDGE[1]}|CIP数据|图书在版编目") | (text.rlike("(?i)ISBN") & text.rlike("版权所有|责任编辑|责任印制"))


def is_colophon(paragraph: Column) -> Column:
    return paragraph.rlike("(?i:ISBN)|版权所有|责任印制|责任编辑|限于时间和水平")


def is_instructional(paragraph: Column) -> Column:
    """Teaches: the 7-38-55 rule, a quotation with a cue, a named method, or a dotted name with a cue."""
    cue = paragraph.rlike(CUES)
    return (
        paragraph.rlike(rf"7{WS}*[%％].{{0,40}}38.{{0,40}}55|7.{{0,20}}38.{{0,20}}55.{{0,20}}[%％]")
        | (paragraph.rlike("[“\"「].+[”\"」]") & cue)
        | paragraph.rlike(rf"{EDGE[0]}(?:METT|FACS){EDGE[1]}")
        | (paragraph.rlike(f"[{HAN}]·[{HAN}]") & cue)
    )


def is_sales_copy(paragraph: Column) -> Column:
    return paragraph.rlike(SALES)


def has_choices(text: Column) -> Column:
    """Has options A, B and C, as a quiz does."""
    return text.rlike(rf"(?:^|{WS})A[.．、]") & text.rlike(rf"(?:^|{WS})B[.．、]") & text.rlike(rf"(?:^|{WS})C[.．、]")


def is_chapter(title: Column, stable: bool = True) -> Column:
    return normalize_title(title, stable).rlike(CHAPTER)


def is_section(title: Column, stable: bool = True) -> Column:
    return normalize_title(title, stable).rlike(SECTION)


def is_front_or_back_matter(title: Column, stable: bool = True) -> Column:
    key = compact_key(title, stable)
    head = F.substring(F.translate(normalize_title(title, stable), " ", ""), 1, 8)
    return key.isin("preface", *BIBLIOGRAPHY_WORDS) | key.contains("后记") | head.rlike("|".join(PREFACE_WORDS))


def is_magazine_quiz(title: Column) -> Column:
    return title.rlike(rf"^心理测试[\s\x{{3000}}:：]+.+$")


def numbered_depth(title: Column, stable: bool = True) -> Column:
    """2 for 1.1, 3 for 1.1.1; null for a bare number or none."""
    number = F.regexp_extract(normalize_title(title, stable), r"^(\p{Nd}+(?:[.\-．]\p{Nd}+)+)(?![\p{L}\p{N}_])", 1)
    return F.when(number != "", F.regexp_count(number, F.lit(r"[.\-．]")) + 1)


def structural_level(title: Column, raw: Column, stable: bool = True) -> Column:
    """Chapters and front or back matter 1, sections 2, numbered titles their depth, else the heading's own level."""
    return (
        F.when(is_chapter(title, stable) | is_front_or_back_matter(title, stable), 1)
        .when(is_section(title, stable), 2)
        .otherwise(F.coalesce(numbered_depth(title, stable), F.greatest(raw, F.lit(1))))
    )


def is_short_topical(title: Column, raw: Column, stable: bool = True) -> Column:
    return (raw == 1) & (F.length(title) <= 40) & ~is_chapter(title, stable) & ~is_section(title, stable) & ~is_front_or_back_matter(title, stable) & numbered_depth(title, stable).isNull()


def section_kind(title: Column, body: Column, stable: bool = True) -> Column:
    """bibliography, preface, skill_test, quiz or body, the first that fits."""
    return (
        F.when(is_bibliography_heading(title, stable), "bibliography")
        .when(is_preface_heading(title, stable) | is_afterword(title, stable), "preface")
        .when(title.rlike(SKILL_TEST), "skill_test")
        .when(title.contains("心理测试") & (has_choices(body) | body.contains("结果分析")), "quiz")
        .otherwise("body")
    )


def path_is_under(path: Column, parent: Column) -> Column:
    """A strict prefix test on heading paths."""
    return (F.size(path) > F.size(parent)) & (F.slice(path, F.lit(1), F.greatest(F.size(parent), F.lit(1))) == parent)
