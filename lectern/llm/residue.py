"""Template residue and error pages in place of what should be read.

Unfilled placeholders are found by their delimiters around a name, whatever
its length. For the rest, labelled exemplars of notices, filler and page frames
are retrieved for each passage window of a document through an inverted index
of their terms. A window's terms that the retrieved exemplars contain are
covered; a document whose TF-IDF mass is covered for the most part, a headline
and lines of navigation aside, is excluded. Frequencies are counted over all
documents, for the terms of the exemplars only.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import exemplars as default

#: The covered share of a document's mass from which it is residue, and the share of an exemplar's or a window's mass they have in common when one is retrieved.
COVERED, IN_EXEMPLAR, IN_WINDOW = 0.25, 0.2, 0.3
#: Segments in a passage window at most.
WINDOW = 3

_NAME = r"[$]?[A-Za-z_一-鿿][\w.一-鿿-]*+"
#: Delimiters that stand around an unfilled name. Single braces need a bare name: lists and numbers in braces are prose.
PLACEHOLDER = re.compile(
    rf"\{{\{{[^{{}}\n]+\}}\}}|[$#]\{{\s*{_NAME}\s*\}}|\{{%[-\s](?:[^\n%{{]|%(?!\}})|\{{(?!%))+%\}}|\{{{_NAME}\}}|｛\s*{_NAME}\s*｝"
    rf"|<%[=\s-](?:[^\n%<]|%(?!>)|<(?!%))+%>|<\?=?\s*(?:php|\$)(?:[^\n?<]|\?(?!>)|<(?!\?))*\?>|<<\s*{_NAME}\s*>>|&lt;\s*{_NAME}\s*&gt;"
    rf"|%%{_NAME}%%|@@{_NAME}@@|(?<![\w_])__[A-Za-z一-鿿](?:[A-Za-z0-9.一-鿿]|_(?!_))*+__(?!\w)|(?<=[一-鿿])__[A-Za-z一-鿿](?:[A-Za-z0-9.一-鿿]|_(?!_))*+__|\[\[\s*{_NAME}\s*\]\]"
    rf"|[【\[](?:请|請)?(?:填写|填寫|填入|输入|輸入|插入|在此|此处|此處)[^【】\[\]\n]*[】\]]|\[(?:INSERT|ENTER|YOUR|ADD|TODO|PLACEHOLDER)\b[^\[\]\n]*\]|\bINSERT_[A-Z_]+\b",
)

#: One of these is in every placeholder.
_OPENERS = ("{", "｛", "<%", "<?", "<<", "&lt;", "%%", "@@", "__", "[", "【", "INSERT_")

_WORD = re.compile(r"[a-z0-9]+(?:'[a-z]+)?")
_STATUS = re.compile(r"[45]\d\d")
#: A product and its version, as servers sign their pages.
_BANNER = re.compile(r"[\w-]+/\d+(?:\.\d+)+")
#: Between the items of a line of navigation.
_BETWEEN = re.compile(r"\s*[>›»→|｜·/]\s*")
#: Ends of sentences, after which a line is no headline.
_ENDS = frozenset("。！？!?；;.…")
#: Function words of English, which are no terms, and which pseudo-Latin lacks.
_FUNCTION = frozenset(
    "the of and to is that a an in it its for with when because on was were are be been being this these those there you your we our us they their them not or nor at by from as has have had her his she he him"
    " how what which who while where why do does did can could may might will would shall should must if no so but than then one some any all each into over under out up about after before i me my".split()
)


def _folding() -> np.ndarray:
    """Case, width and script folded, character by character."""
    fold = np.arange(0x110000, dtype=np.uint32)
    fold[0xFF01:0xFF5F] = np.arange(0x21, 0x7F)
    for code in [*range(ord("A"), ord("Z") + 1)]:
        fold[code] = fold[code + 0xFEE0] = code + 32
    fold[0x2019] = ord("'")
    for code, plain in default.one_script().items():
        fold[code] = ord(plain)
    return fold


_FOLD = _folding()
_HAN = np.zeros(0x110000, bool)
_HAN[0x3400:0xA000] = _HAN[0xF900:0xFB00] = True
_STOP = np.zeros(0x110000, bool)
_STOP[[ord(c) for c in "\n。！？!?；;"]] = True


class Terms:
    """The terms of a text where they stand: words and codes in Latin letters, pairs of Han characters, and Han characters between others. Numbers are none."""

    def __init__(self, text: str):
        points = _FOLD[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        self.folded = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        han = np.r_[_HAN[points], False]
        pair = np.flatnonzero(han[:-1] & han[1:])
        alone = np.flatnonzero(han[:-1] & ~han[1:] & ~np.r_[False, han[:-2]])
        self.han_at = np.r_[pair, alone]
        self.paired = np.r_[np.ones(len(pair), bool), np.zeros(len(alone), bool)]
        wide = points.astype(np.int64)
        self.han = np.r_[(wide[pair] << 21) | wide[pair + 1] if len(pair) else np.zeros(0, np.int64), wide[alone]]
        words = ((m.start(), "#" if _STATUS.fullmatch(m.group()) else m.group()) for m in _WORD.finditer(self.folded))
        found = [(at, w) for at, w in words if not w.isdigit() and w not in _FUNCTION]
        self.words = [w for _, w in found]
        self.words_at = np.array([at for at, _ in found], np.int64)
        stop = _STOP[points]
        dot = np.flatnonzero(points == ord("."))
        if len(dot):
            after = points[np.minimum(dot + 1, len(points) - 1)]
            stop[dot[(dot + 1 == len(points)) | (after == 32) | (after == 10)]] = True
        self.segment = np.cumsum(stop) - stop


class Exemplars:
    """Labelled exemplars and the inverted index of their terms."""

    def __init__(self, labelled: Iterable[tuple[str, str]] | None = None) -> None:
        self.labels: list[str] = []
        self.held: list[frozenset[int]] = []
        words: dict[str, int] = {}
        pairs: dict[int, int] = {}
        seen = set()
        size = 0
        for label, text in labelled if labelled is not None else default.labelled():
            terms, own = Terms(text), set()
            for table, keys in ((words, terms.words), (pairs, terms.han.tolist())):
                for key in keys:
                    if key not in table:
                        table[key] = size
                        size += 1
                    own.add(table[key])
            if own and (held := frozenset(own)) not in seen:
                seen.add(held)
                self.labels.append(label)
                self.held.append(held)
        self.size, self._words = size, words
        self._pairs = np.array(sorted(pairs), np.int64)
        self._numbers = np.array([pairs[p] for p in sorted(pairs)], np.int64)
        self.index: dict[int, list[int]] = defaultdict(list)
        for number, held in enumerate(self.held):
            for term in held:
                self.index[term].append(number)

    def numbers(self, terms: Terms) -> tuple[np.ndarray, np.ndarray]:
        """``(places, numbers)`` of all terms of a text, in no order; -1 for those of no exemplar."""
        if len(self._pairs) and len(terms.han):
            at = np.minimum(np.searchsorted(self._pairs, terms.han), len(self._pairs) - 1)
            han = np.where(self._pairs[at] == terms.han, self._numbers[at], -1)
        else:
            han = np.full(len(terms.han), -1, np.int64)
        known = self._words.get
        return np.r_[terms.han_at, terms.words_at], np.r_[han, np.array([known(w, -1) for w in terms.words], np.int64)]

    def weigh(self, weights: np.ndarray, rare: float) -> None:
        """Sets the weights of the exemplars' terms and that of any other term."""
        self.weights = np.r_[weights, rare]
        self._weight = weights.tolist()
        self.masses = [sum(self._weight[t] for t in held) for held in self.held]

    def covered(self, window: set[int], mass: float) -> tuple[set[int], set[int]]:
        """The terms of a window of that mass that its exemplars contain, and these exemplars."""
        shared: Counter[int] = Counter()
        for term in window:
            for number in self.index[term]:
                shared[number] += self._weight[term]
        met = {n for n, weight in shared.items() if weight >= IN_EXEMPLAR * self.masses[n] or weight >= IN_WINDOW * mass}
        return {t for n in met for t in self.held[n] & window}, met


def _aside(text: str) -> list[tuple[int, int]]:
    """The stretches of a text that say nothing by themselves: its headline, lines of navigation, and banners of servers."""
    lines, at = [], 0
    for line in text.split("\n"):
        if line.strip():
            lines.append((at, line))
        at += len(line) + 1
    out = []
    for number, (at, line) in enumerate(lines):
        bare = line.strip()
        parts = [p for p in _BETWEEN.split(bare) if p]
        headline = number == 0 and len(lines) > 1 and bare[-1] not in _ENDS
        if headline or _BANNER.fullmatch(bare) or (len(parts) > 2 and all(len(p) < 20 for p in parts)):
            out.append((at, at + len(line)))
    return out


def is_filler(text: str) -> bool:
    """Pseudo-Latin filler: its mark words, and hardly any of a language's function words."""
    lower = text.lower()
    if "lorem" not in lower and "ipsum" not in lower:
        return False
    words = re.findall(r"[a-z]+", lower)
    marks = sum(w in ("lorem", "ipsum") for w in words)
    return marks > 0 and len(words) >= 0.6 * len(re.findall(r"\w+", text)) and marks >= 0.01 * len(words) and sum(w in _FUNCTION for w in words) <= 0.05 * len(words)


def _counted(terms: Terms, held: np.ndarray) -> np.ndarray:
    """Which terms count: all but pairs not held that only straddle two which are."""
    at, size = terms.han_at, len(terms.segment) + 1
    chars = np.zeros(size, bool)
    own = at[held[: len(at)]]
    chars[own] = True
    paired = own[terms.paired[held[: len(at)]]]
    chars[paired + 1] = True
    out = np.ones(len(held), bool)
    out[: len(at)] = held[: len(at)] | ~(chars[at] & chars[np.minimum(at + terms.paired, size - 1)])
    return out


def residue_kind(text: str | None, exemplars: Exemplars) -> str | None:
    """placeholder, filler, notice or frame; null for real content and for null, empty and blank texts."""
    if not text or not text.strip():
        return None
    if any(mark in text for mark in _OPENERS) and PLACEHOLDER.search(text):
        return "placeholder"
    if is_filler(text):
        return "filler"
    terms = Terms(text)
    places, numbers = exemplars.numbers(terms)
    if not len(numbers):
        return None
    known = numbers >= 0
    mass = exemplars.weights[numbers] * _counted(terms, known)
    said = np.ones(len(places), bool)
    asides = None

    def mostly(held: np.ndarray, mass: np.ndarray) -> bool:
        """Whether what is held is most of the text, or of what is left without what stands aside."""
        nonlocal said, asides
        if mass[held].sum() >= COVERED * mass.sum():
            return True
        if asides is None:
            asides = _aside(text)
            for a, b in asides:
                said &= (places < a) | (places >= b)
        return bool(said.any()) and mass[held & said].sum() >= COVERED * mass[said].sum()

    # no more can be covered than is known
    if not mostly(known, mass):
        return None
    segments = terms.segment[places]
    held: dict[int, list[int]] = defaultdict(list)
    sizes: Counter[int] = Counter()
    for segment, number, weight in zip(segments.tolist(), numbers.tolist(), mass.tolist(), strict=True):
        sizes[segment] += weight
        held[segment].append(number)
    order = sorted(held)
    covered: dict[int, set[int]] = defaultdict(set)
    met: set[int] = set()
    for first in range(len(order)):
        window: set[int] = set()
        size = 0.0
        for count in range(1, min(WINDOW, len(order) - first) + 1):
            segment = order[first + count - 1]
            window |= {n for n in held[segment] if n >= 0}
            size += sizes[segment]
            found, numbers_met = exemplars.covered(window, size)
            met |= numbers_met
            for inside in order[first : first + count]:
                covered[inside] |= found
    is_covered = np.array([n >= 0 and n in covered[s] for s, n in zip(segments.tolist(), numbers.tolist(), strict=True)])
    if not mostly(is_covered, exemplars.weights[numbers] * _counted(terms, is_covered)):
        return None
    by_label: Counter[str] = Counter()
    for number in met:
        by_label[exemplars.labels[number]] += exemplars.masses[number]
    return by_label.most_common(1)[0][0]


def weights_over(docs: DataFrame, exemplars: Exemplars) -> tuple[np.ndarray, float]:
    """The weight of each term of the exemplars by its frequency over all documents, and that of any other term."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(exemplars.size, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += 1
                numbers = np.unique(exemplars.numbers(Terms(text))[1])
                counts[numbers[numbers >= 0]] += 1
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *held.tolist()], pa.int32()), pa.array([total, *counts[held].tolist()], pa.int64())], names=["term", "n"])

    rows = docs.select("text").where(F.col("text").isNotNull()).mapInArrow(counted, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r.term: r.n for r in rows}
    total = found.get(-1, 0)
    weight = lambda n: math.log((total + 1) / (n + 1)) + 0.5
    # a term of no exemplar is taken as one of moderate frequency, whatever the corpus; no term weighs more
    rare = weight(total / 1000)
    return np.array([min(weight(found.get(i, 0)), rare) for i in range(exemplars.size)]), rare


def residue(docs: DataFrame, labelled: Iterable[tuple[str, str]] | None = None) -> DataFrame:
    """``(doc_id, kind)`` of every document to exclude; see residue_kind.

    ``labelled`` are exemplars as (label, text) with the labels notice, filler
    and frame, a table that is broadcast; without it those of ``exemplars`` are
    taken. Repeated rows repeat; extra columns are ignored.
    """
    exemplars = Exemplars(labelled)
    exemplars.weigh(*weights_over(docs, exemplars))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [residue_kind(text, exemplars) for text in batch.column(1).to_pylist()]
            keep = [i for i, kind in enumerate(kinds) if kind]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array([kinds[i] for i in keep], pa.string())], names=["doc_id", "kind"])

    schema = docs.select("doc_id").schema.add("kind", "string")
    return docs.select("doc_id", "text").mapInArrow(judged, schema)


def without_residue(docs: DataFrame) -> DataFrame:
    """The documents that are left."""
    return docs.join(residue(docs).select("doc_id").distinct(), "doc_id", "left_anti")
