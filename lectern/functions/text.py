"""Text expressions. All but NFKC stay in the JVM as built-in functions.

Lengths and positions count code points. White space is the Unicode class
throughout, as the engine's texts use U+3000 and no-break spaces.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: White space within a line.
BLANK = r"[ \t\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
NOT_WORD = r"[^\p{L}\p{N}_]+"
#: Marks that headings are compared without.
PUNCTUATION = r"[：:、，。！？!?,;；\-—–_·•\.．]+"
HAN = r"\x{4e00}-\x{9fff}"


def _to_nfkc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for values in batches:
        yield values.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))


def nfkc(text: Column) -> Column:
    """NFKC, the one text function that Spark lacks; Arrow batches, ASCII passed through."""
    return F.pandas_udf(_to_nfkc, "string")(text)


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, f"^{WS}+|{WS}+$", "")


def joined_space(text: Column) -> Column:
    return trimmed(F.regexp_replace(text, f"{WS}+", " "))


def normalize_text(text: Column, stable: bool = False) -> Column:
    """The form in which texts are shingled: NFKC, without emphasis marks, words and ideographs only. ``stable``: the text is in NFKC already."""
    base = text if stable else nfkc(text)
    return F.regexp_replace(F.regexp_replace(base, r"[*_`]+", ""), NOT_WORD, "")


def content_hash(text: Column, stable: bool = False) -> Column:
    """SHA-256 of the text's words; an underscore counts as a word character."""
    return F.sha2(F.regexp_replace(text if stable else nfkc(text), NOT_WORD, ""), 256)


def display_title(title: Column) -> Column:
    """As shown: without emphasis, ideographic spaces as spaces, runs of spaces joined."""
    bare = F.regexp_replace(title, r"[*_`]+", "")
    return trimmed(F.regexp_replace(F.translate(bare, "　", " "), " +", " "))


def normalize_title(title: Column, stable: bool = False) -> Column:
    return joined_space(F.regexp_replace(title if stable else nfkc(title), r"[*_`]+", ""))


def compact_key(title: Column, stable: bool = False) -> Column:
    """The key by which titles are matched: normalized, lower case, no punctuation or space."""
    return F.lower(F.regexp_replace(F.regexp_replace(normalize_title(title, stable), f"{WS}+", ""), PUNCTUATION, ""))


def heading_path_key(path: Column, stable: bool = True) -> Column:
    """A heading path as one string. NFKC can't run inside a lambda, so an unstable path is joined first and normalized whole."""
    if stable:
        return F.array_join(F.transform(path, lambda x: normalize_title(x, True)), ">")
    mark = "\x02"
    return F.array_join(F.transform(F.split(nfkc(F.array_join(path, mark)), mark), lambda x: normalize_title(x, True)), ">")


def excerpt(text: Column, size: int = 40) -> Column:
    """The first characters of the text without any white space, with an ellipsis if there are more."""
    bare = F.regexp_replace(text, f"{WS}+", "")
    return F.when(F.length(bare) > size, F.concat(F.substring(bare, 1, size), F.lit("……"))).otherwise(bare)


def visible_line(line: Column) -> Column:
    """What a reader sees of a line: no heading marks, list marker or emphasis around it."""
    bare = F.regexp_replace(trimmed(line), f"^#+{WS}*", "")
    bare = F.regexp_replace(bare, rf"^(?:[-*+]|[0-9]+[.)、]|[一二三四五六七八九十]+、){WS}+", "")
    for mark in (r"\*\*", "__", r"\*", "_"):
        bare = F.regexp_replace(bare, f"^{mark}(.*){mark}$", "$1")
    return trimmed(bare)


def paragraphs(text: Column) -> Column:
    """The parts between blank lines, without blank ones."""
    parts = F.transform(F.split(text, rf"\n{WS}*\n"), lambda x: F.regexp_replace(x, r"^\n+|\n+$", ""))
    return F.filter(parts, lambda x: trimmed(x) != "")


def body_text(lines: Column) -> Column:
    """An array of lines without horizontal rules, joined, without line ends around it."""
    kept = F.filter(lines, lambda x: ~x.rlike(rf"^{WS}*(?:-{{3,}}|\*{{3,}}|_{{3,}}){WS}*$"))
    return F.regexp_replace(F.array_join(kept, "\n"), r"^\n+|\n+$", "")


_CAPTION = rf"^{WS}*(?:\*\*|__)?{WS}*图{WS}*\p{{Nd}}+(?:[.\-－—]\p{{Nd}}+)?(?:{WS}+.+?)?{WS}*(?:\*\*|__)?{WS}*$"


def figure_captions(text: Column) -> Column:
    """Lines that are only a figure's caption become a note; lines that refer to a figure stay."""

    def line(x: Column) -> Column:
        bare = trimmed(F.regexp_replace(trimmed(x), r"^(?:\*\*|__)|(?:\*\*|__)$", ""))
        note = F.concat(F.lit("*[Figure omitted from source conversion: "), bare, F.lit("]*"))
        return F.when(x.rlike(_CAPTION) & ~x.contains("如图"), note).otherwise(x)

    return F.array_join(F.transform(F.split(text, "\n"), line), "\n")


def without_rules(text: Column) -> Column:
    """Captions rewritten, horizontal rules dropped, blank runs collapsed."""
    kept = F.filter(F.split(figure_captions(text), "\n"), lambda x: ~x.rlike(rf"^{WS}*(?:-{{3,}}|\*{{3,}}|_{{3,}}){WS}*$"))
    return F.regexp_replace(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"), r"^\n+|\n+$", "")


# --- headings of a finished document -------------------------------------------------------------


def without_front_matter(text: Column) -> Column:
    return F.regexp_replace(text, r"\A---\r?\n(?s:.*?)\r?\n---\r?\n?", "")


def headings(text: Column) -> Column:
    """``array<struct<level, title>>`` of the ATX headings, in order, front matter aside."""
    line = rf"^(#{{1,6}}){BLANK}+(.*[^\s\x{{3000}}]){BLANK}*$"
    found = F.filter(F.split(without_front_matter(text), "\n"), lambda x: x.rlike(line))
    return F.transform(found, lambda x: F.struct(F.length(F.regexp_extract(x, line, 1)).alias("level"), trimmed(F.regexp_extract(x, line, 2)).alias("title")))


def heading_levels(text: Column, most: int = 6) -> Column:
    return F.filter(F.transform(headings(text), lambda h: h["level"]), lambda x: x <= most)


def first_heading(text: Column) -> Column:
    return F.try_element_at(headings(text), F.lit(1))["title"]


def count_h1(text: Column) -> Column:
    return F.size(F.filter(headings(text), lambda h: h["level"] == 1))


def contents_list(found: Column) -> Column:
    """A table of contents of the headings from level 2 on, two spaces for each further level."""
    rows = F.filter(found, lambda h: h["level"] >= 2)
    return F.array_join(F.transform(rows, lambda h: F.concat(F.repeat(F.lit("  "), h["level"] - 2), F.lit("- "), h["title"])), "\n")


def retarget_headings(text: Column, level: int) -> Column:
    """All headings shifted so that the first is at ``level``; levels stay within 1 to 6."""
    first = F.try_element_at(headings(text), F.lit(1))["level"]
    line = rf"^(#{{1,6}})({BLANK}+.*)$"

    def moved(x: Column) -> Column:
        target = F.least(F.greatest(F.length(F.regexp_extract(x, line, 1)) + F.lit(level) - first, F.lit(1)), F.lit(6))
        return F.when(x.rlike(line), F.concat(F.repeat(F.lit("#"), target), F.regexp_extract(x, line, 2))).otherwise(x)

    return F.when(first.isNull(), text).otherwise(F.array_join(F.transform(F.split(text, "\n"), moved), "\n"))


def without_leading_heading(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{WS}*#{{1,6}}{BLANK}+[^\n]*\n*", "")


def without_inner_headings(text: Column) -> Column:
    kept = F.filter(F.split(text, "\n"), lambda x: ~x.rlike(rf"^#{{1,6}}{BLANK}+[^\s]"))
    return trimmed(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"))


def without_han_in_headings(text: Column) -> Column:
    """Ideographs taken out of heading lines, unless nothing would be left."""

    def line(x: Column) -> Column:
        mark = F.regexp_extract(x, rf"^(#{{1,6}}){BLANK}+", 1)
        title = trimmed(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, rf"^#{{1,6}}{BLANK}+", ""), f"[{HAN}]", ""), r"\s{2,}", " "))
        return F.when((mark != "") & x.rlike(f"[{HAN}]") & (title != ""), F.concat(mark, F.lit(" "), title)).otherwise(x)

    return F.array_join(F.transform(F.split(text, "\n"), line), "\n")


def sections_at(text: Column, level: int) -> Column:
    """``array<struct<title, body>>`` of the parts that begin with a heading of exactly ``level``; what comes before has a null title."""
    mark = "#" * level + " "
    parts = F.filter(F.split(without_front_matter(text), f"(?md)(?=^{mark})"), lambda x: trimmed(x) != "")
    titled = rf"\A{mark}{BLANK}*([^\n]*?){BLANK}*(?:\n|\z)"
    return F.transform(parts, lambda x: F.struct(F.nullif(F.regexp_extract(x, titled, 1), F.lit("")).alias("title"), trimmed(F.regexp_replace(x, titled, "")).alias("body")))


# --- counts ---------------------------------------------------------------------------------------


def han_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{HAN}]"))


def word_count(text: Column) -> Column:
    """Runs of anything but white space, front matter aside."""
    return F.regexp_count(without_front_matter(text), F.lit(WS.replace("[", "[^", 1) + "+"))


def particle_counts(text: Column) -> Column:
    """``struct<mandarin, cantonese>``: how often the marking particles of the two occur."""
    return F.struct(F.regexp_count(text, F.lit("[的是不]")).alias("mandarin"), F.regexp_count(text, F.lit("[嘅係唔]")).alias("cantonese"))


def without_tags(text: Column) -> Column:
    return F.regexp_replace(text, r"\[[^\]\n]+#[^\]\n]+\]", "")


def han_density(text: Column) -> Column:
    """The share of ideographs in a translation, parentheses, tags and front matter aside."""
    bare = without_tags(F.regexp_replace(without_front_matter(text), r"\([^)]*\)|（[^）]*）", ""))
    return F.coalesce(F.try_divide(han_count(bare), F.length(bare)), F.lit(0.0))


def cantonese_verdict(text: Column, simplified: str = "", ratio: float = 3.0, per_han: int = 500) -> Column:
    """``struct<passed, reasons>``: written Cantonese has few Mandarin particles, enough of its own, and no simplified characters (those of ``simplified``)."""
    body = F.regexp_replace(without_tags(without_front_matter(text)), "[A-Za-z]+", "")
    counts = particle_counts(body)
    han = han_count(body)
    found = distinct_of(body, simplified)
    reasons = F.filter(
        F.array(
            F.when(F.size(found) > 0, F.concat(F.lit("simplified: "), F.array_join(F.slice(found, 1, 24), ""))),
            F.when(counts["mandarin"] > F.lit(ratio) * F.greatest(counts["cantonese"], F.lit(1)), F.lit("particle ratio")),
            F.when((han > 0) & (counts["cantonese"] * per_han < han), F.lit("particle density")),
        ),
        lambda x: x.isNotNull(),
    )
    return F.struct((F.size(reasons) == 0).alias("passed"), reasons.alias("reasons"))


def distinct_of(text: Column, characters: str) -> Column:
    """Those of ``characters`` that occur in the text, distinct, in the order of their first occurrence."""
    if not characters:
        return F.array().cast("array<string>")
    kept = F.regexp_replace(text, "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in characters) + "]", "")
    return F.filter(F.array_distinct(F.split(kept, "")), lambda x: x != "")


def script_converted(text: Column, source: str, target: str, phrases: dict[str, str] | None = None) -> Column:
    """Characters of ``source`` replaced by those of ``target`` in one pass, after whole phrases; the first pair of a repeated character wins."""
    for old, new in (phrases or {}).items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.translate(text, source, target)


# --- cutting and packing --------------------------------------------------------------------------


def hard_split(text: Column, size: int) -> Column:
    """Slices of ``size`` characters; an empty text has none."""
    starts = F.sequence(F.lit(0), F.ceil(F.length(text) / size).cast("int") - 1)
    return F.when(F.length(text) > 0, F.transform(starts, lambda i: F.substring(text, i * size + 1, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def packed_paragraphs(parts: Column, limit: int, separator: int = 2) -> Column:
    """Paragraphs joined greedily to chunks of at most ``limit`` characters; a longer paragraph stays whole. ``separator`` is the cost of a join."""

    def step(acc: Column, part: Column) -> Column:
        last = F.element_at(acc, -1)
        fits = (F.size(acc) > 0) & (F.length(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(""))) + F.length(part) + separator <= limit)
        return F.when(fits, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.concat(last, F.lit("\n\n"), part)))).otherwise(F.concat(acc, F.array(part)))

    return F.aggregate(parts, F.array().cast("array<string>"), step)


def overlapped_chunks(text: Column, limit: int) -> Column:
    """Chunks of paragraphs of at most ``limit`` characters, each beginning with the last paragraph of the one before if both fit."""
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("done"), empty.alias("open"))

    def step(acc: Column, part: Column) -> Column:
        trial = F.array_join(F.concat(acc["open"], F.array(part)), "\n\n")
        tail = F.concat(F.slice(acc["open"], -1, 1), F.array(part))
        closed = F.concat(acc["done"], F.array(F.array_join(acc["open"], "\n\n")))
        kept = F.when(F.length(F.array_join(tail, "\n\n")) <= limit, tail).otherwise(F.array(part))
        fits = (F.size(acc["open"]) == 0) | (F.length(trial) <= limit)
        return F.struct(F.when(fits, acc["done"]).otherwise(closed).alias("done"), F.when(fits, F.concat(acc["open"], F.array(part))).otherwise(kept).alias("open"))

    return F.aggregate(paragraphs(text), start, step, lambda acc: F.when(F.size(acc["open"]) > 0, F.concat(acc["done"], F.array(F.array_join(acc["open"], "\n\n")))).otherwise(acc["done"]))


def translation_chunks(text: Column, limit: int) -> Column:
    """Chunks of at most ``limit`` characters: cut before headings of level 4, longer ones at blank lines, longer ones anywhere; neighbours joined while they fit."""

    def cut(part: Column) -> Column:
        return F.when(F.length(part) <= limit, F.array(part)).otherwise(hard_split(part, limit))

    pieces = F.flatten(F.transform(F.split(text, r"(?md)(?=^#### )"), lambda x: F.when(F.length(trimmed(x)) <= limit, F.array(trimmed(x))).otherwise(F.flatten(F.transform(paragraphs(x), cut)))))
    return packed_paragraphs(F.filter(pieces, lambda x: x != ""), limit)


def script_chunks(text: Column) -> Column:
    """Parts before each heading of level 1 to 3; a part that is only a heading goes with the next one."""
    parts = F.filter(F.transform(F.split(without_front_matter(text), r"(?md)(?=^#{1,3} )"), trimmed), lambda x: x != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("held"))

    def step(acc: Column, part: Column) -> Column:
        joined = F.when(acc["held"] == "", part).otherwise(F.concat(acc["held"], F.lit("\n\n"), part))
        bare = part.rlike(r"\A#{1,3} [^\n]*\z")
        return F.struct(F.when(bare, acc["done"]).otherwise(F.concat(acc["done"], F.array(joined))).alias("done"), F.when(bare, joined).otherwise("").alias("held"))

    return F.aggregate(parts, start, step, lambda acc: F.when(acc["held"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["held"]))))


def without_fences(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\A\s*```(?:text|markdown|json)?\s*", ""), r"\s*```\s*\z", "")


def spread(parts: Column, groups: Column) -> Column:
    """An array split into ``groups`` even slices, the i-th from ``i*n//k`` to ``(i+1)*n//k``."""
    n = F.size(parts)
    bound = lambda i: F.floor(i * n / groups).cast("int")
    return F.transform(F.sequence(F.lit(0), groups - 1), lambda i: F.slice(parts, bound(i) + 1, bound(i + 1) - bound(i)))


def humanized(name: Column) -> Column:
    """A topic's name as a title."""
    return F.initcap(F.translate(name, "-_", "  "))


def yaml_quoted(value: Column) -> Column:
    special = (value == "") | value.rlike(r"""[:#\[\]{},&*!|>'"%@`\\]|^[\s?-]|\s$""")
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.when(special, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(value)
