"""One consistent form for text that looks the same.

A quick-check class finds the characters that make a text unstable; only the
segment around each is normalized, with the base character before it and the
marks after it as context, and spliced back. Text without such characters is
returned as it is. What is returned has no such character any more: a mark that
no letter can be composed with is dropped, a mixed word is brought to one
script. Ordinary writing stays: full-width punctuation, U+3000,
tabs, line ends, precomposed accents, words wholly in Greek or Cyrillic, and
emoji with their joiners.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where characters stand that normalization may change, but for those of single scripts beyond Latin, Greek, Cyrillic, kana and ideographs.
_SCOPE = [*range(0xA0, 0x590), *range(0x1AB0, 0x1B00), *range(0x1D00, 0x3100), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x2F800, 0x2FA1E)]


def _class(of: Callable[[str], bool]) -> str:
    """The characters of a property as ranges for a regular expression."""
    ranges: list[list[int]] = []
    for code in _SCOPE:
        if of(chr(code)):
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "".join(f"{chr(a)}-{chr(b)}" if a < b else chr(a) for a, b in ranges)


def _unstable(c: str) -> bool:
    """The quick check of NFKC says no: the character never stands in a normalized text."""
    return not unicodedata.is_normalized("NFKC", c)


def _kind(c: str) -> str:
    return unicodedata.decomposition(c).partition(">")[0] if unicodedata.decomposition(c).startswith("<") else ""


WIDE = _class(lambda c: _unstable(c) and _kind(c) == "<wide" and unicodedata.normalize("NFKC", c).isalnum() and unicodedata.normalize("NFKC", c).isascii())
#: Quick check maybe: combining accents, without the keycap and the variation selectors of emoji.
MARK = _class(lambda c: unicodedata.combining(c) > 0 and unicodedata.name(c, "").startswith("COMBINING") and not "\u2de0" <= c <= "\u2dff")
SPACE = _class(lambda c: unicodedata.category(c) == "Zs" and c != "\u3000")
#: Radicals, which normalization changes or has no word for, and compatibility forms but for the twelve unified ideographs in their block.
FORM = _class(lambda c: "RADICAL" in unicodedata.name(c, "") or (_unstable(c) and unicodedata.name(c, "").startswith("CJK COMPATIBILITY IDEOGRAPH")))
#: Styled letters, half-width kana and ligatures: unstable, but no case of those that are listed as unusual.
VARIANT = _class(lambda c: _unstable(c) and (_kind(c) in ("<font", "<narrow") or "LIGATURE" in unicodedata.name(c, "")) and unicodedata.normalize("NFKC", c)[0].isalpha())
HIDDEN = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180e\u200b\u200c\u200e\u200f\u202a-\u202e\u2060-\u2064\u2066-\u206f\u3164\ufeff\ufff9-\ufffb"
LATIN = f"A-Za-z\u00aa\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u1e00-\u1effＡ-Ｚａ-ｚ"
OTHER = "\u0370-\u0373\u0376\u0377\u037b-\u037d\u037f\u0386\u0388-\u03ff\u1f00-\u1fff\u0400-\u0481\u048a-\u052f\u1c80-\u1c88\u2de0-\u2dff\ua640-\ua69f"
EMOJI = "\u00a9\u00ae\u203c\u2049\u2122\u2139\u2194-\u21aa\u231a-\u23ff\u24c2\u25aa-\u25fe\u2600-\u27bf\u2934-\u2935\u2b05-\u2b55\u3030\u303d\u3297\u3299\ufe0f\U0001f000-\U0001faff"
_JOINER = f"(?<![{EMOJI}])\u200d|\u200d(?![{EMOJI}])"
_TAGS = "(?<![\U0001f3f4\U000e0020-\U000e007e])[\U000e0001\U000e0020-\U000e007f]"
_GAP = f"[{MARK}{HIDDEN}\u200d]*"
_MIXED = f"[{LATIN}]{_GAP}[{OTHER}]|[{OTHER}]{_GAP}[{LATIN}]"

CLASSES = {
    "wide": re.compile(f"[{WIDE}]"),
    "mark": re.compile(f"[{MARK}]"),
    "hidden": re.compile(f"[{HIDDEN}]|{_JOINER}|{_TAGS}"),
    "space": re.compile(f"[{SPACE}]"),
    "form": re.compile(f"[{FORM}]"),
    "mixed": re.compile(_MIXED),
    "variant": re.compile(f"[{VARIANT}]"),
}
#: The kinds that make a field unusual; variants are settled, but are none.
UNUSUAL = tuple(name for name in CLASSES if name != "variant")
#: The quick check: a text that it doesn't match is in canonical form already.
_UNSTABLE = re.compile(f"[{WIDE}{MARK}{SPACE}{FORM}{VARIANT}{HIDDEN}]|{_JOINER}|{_TAGS}|{_MIXED}")
_SEGMENT = re.compile(f"(?:[^\\W_])?[{WIDE}{MARK}{SPACE}{FORM}{VARIANT}]+[{MARK}]*")
_GONE = re.compile(f"[{HIDDEN}]|{_JOINER}|{_TAGS}")
_WORD = re.compile(f"[{LATIN}{OTHER}{MARK}]+")
_LATIN, _OTHER = re.compile(f"[{LATIN}]"), re.compile(f"[{OTHER}]")

#: Cyrillic and Greek letters and the Latin letters they look like.
_OTHERS = "АВЕЅІЈКМНОРСТУХҮԌԚԜаеѕіјорсухһԁԛԝүΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορυϲϳ"
_LATINS = "ABESIJKMHOPCTYXYGQWaesijopcyxhdqwyABEZHIKMNOPTYXaivopucj"
LOOKS_LIKE = str.maketrans(_OTHERS, _LATINS)
#: Letters that look like Latin ones only among others of their word.
_LOOSELY = str.maketrans("вкмнтгпиΛΠΣκτγηωεβμ", "bkmhtrnuANEktynwebu")
#: For a word that is Greek or Cyrillic but for Latin letters in it.
_CYRILLIC = {ord(latin): c for c, latin in zip(_OTHERS, _LATINS, strict=True) if "\u0400" <= c}
_GREEK = {ord(latin): c for c, latin in zip(_OTHERS, _LATINS, strict=True) if c < "\u0400" and c not in "ϲϳ"}
#: Radicals that NFKC leaves, and the usual ideographs.
RADICALS = str.maketrans("⺀⺅⺉⺌⺗⺘⺙⺡⺣⺨⺩⺭⺮⺼⻊⻌⻏⻖⻗", "冫人刀小心手攴水火犬玉示竹肉足辵邑阜雨")


def _settle(match: re.Match[str]) -> str:
    segment = match.group()
    return unicodedata.normalize("NFKC", segment).translate(RADICALS)


@lru_cache(4096)
def _romanized(letter: str) -> str:
    """A letter by its Unicode name, in Latin: the last resort for one that looks like no Latin letter."""
    base = unicodedata.normalize("NFD", letter)[0]
    name = unicodedata.name(base, "").split(" WITH ")[0].rpartition(" ")[2]
    # names of consonants begin or end with a vowel that is not part of the sound
    short = re.sub(r"^E(?=[LMNRSF]$)|(?<=[^AEIOU])(?:E|A|HA|ETA|ETTA|AU|OPPA)$", "", name) or name
    return short if letter.isupper() else short.lower()


def _one_script(match: re.Match[str]) -> str:
    """A mixed word in one script: that of the letters which have no look-alike, Latin if both have some."""
    word = match.group()
    if not (_LATIN.search(word) and _OTHER.search(word)):
        return word
    looks = word.translate(LOOKS_LIKE)
    if not _OTHER.search(looks):
        return looks
    for table in (_CYRILLIC, _GREEK):
        other = word.translate(table)
        if not _LATIN.search(other) and len({"\u0400" <= c <= "\u052f" for c in other if c.isalpha()}) == 1:
            return other
    return _OTHER.sub(lambda m: _romanized(m.group()), looks.translate(_LOOSELY))


def classes_of(text: str | None) -> list[str]:
    """The kinds of unusual characters in ``text``, in the order of CLASSES."""
    if not text or not _UNSTABLE.search(text):
        return []
    return [name for name, found in CLASSES.items() if found.search(text)]


def canonical(text: str | None) -> str | None:
    """``text`` with every unstable segment replaced by its canonical form; applying it twice changes nothing more."""
    if not text or not _UNSTABLE.search(text):
        return text
    settled = _SEGMENT.sub(_settle, _GONE.sub("", text))
    # a mark that found no letter to compose with is taken off, after its neighbours are settled
    return _WORD.sub(_one_script, re.sub(f"[{MARK}]", "", settled))


def _fields(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, fields, kinds, values = [], [], [], []
        for key, text, path in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if found := classes_of(text):
                ids.append(key), fields.append("text"), kinds.append(found), values.append([canonical(text)])
            if path and (found := sorted({k for part in path for k in classes_of(part)})):
                ids.append(key), fields.append("heading_path"), kinds.append(found), values.append([canonical(p) for p in path])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.string()), pa.array(fields, pa.string()), pa.array(kinds, pa.list_(pa.string())), pa.array(values, pa.list_(pa.string()))],
            names=["id", "field", "classes", "canonical"],
        )


def uncommon_fields(sections: DataFrame) -> DataFrame:
    """``(id, field, classes, canonical)`` of each field of a section that isn't in canonical form.

    ``canonical`` holds the field's new value, one element for ``text`` and one
    for each of the elements of ``heading_path``. Null and empty values and
    elements are in canonical form; extra columns are ignored.
    """
    return sections.select("id", "text", "heading_path").mapInArrow(_fields, "id string, field string, classes array<string>, canonical array<string>")


def canonical_sections(sections: DataFrame) -> DataFrame:
    """``sections`` with both fields in canonical form, all other columns unchanged."""
    text = F.udf(canonical, "string", useArrow=True)
    path = F.udf(lambda parts: parts if parts is None else [canonical(p) for p in parts], "array<string>", useArrow=True)
    return sections.withColumns({"text": text("text"), "heading_path": path("heading_path")})
