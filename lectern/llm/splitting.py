"""Splitting oversized texts at natural boundaries.

Every position of a text has a boundary strength. A sparse table of range
maxima answers, for each window of permissible piece lengths, where the
strongest cut is; ties go to the right. The next piece starts at the strongest
boundary within the overlap before the cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 4000, 200
PIECES = "id string, piece_no int, start bigint, end bigint, piece string"
#: Boundaries from the weakest to the strongest; the cut is after the match.
_BOUNDARIES = tuple(
    re.compile(p)
    for p in (
        r"[^\W\d_](?=[\W_])|[぀-鿿]",
        r"[ \t　]+",
        r"[，、,;；：:—]+[”’」』）)\]]*\s?",
        r"[。！？!?…]+[”’」』）)\]\"']*|[.][\"')\]]*(?=\s)",
        r"\n",
        r"\n[^\S\n]*\n\s*|\n(?=[#])",
    )
)

_JOINED = re.compile("[\u0300-\u036f\u200d\ufe00-\ufe0f\U0001f3fb-\U0001f3ff]|(?<=\r)\n|(?<=\u200d).")


def boundary_strengths(text: str) -> np.ndarray:
    """``strength[i]`` of a cut before character ``i``; -1 where a cut would split a composed character or a line end."""
    strength = np.zeros(len(text) + 1, np.int8)
    for rank, pattern in enumerate(_BOUNDARIES, 1):
        strength[[m.end() for m in pattern.finditer(text)]] = rank
    joined = [m.start() for m in _JOINED.finditer(text)]
    strength[joined] = -1
    strength[-1] = len(_BOUNDARIES) + 1
    return strength


class RangeMaximum:
    """A sparse table: the rightmost position of the maximum of any range of at most ``widest`` values, by two lookups."""

    def __init__(self, values: np.ndarray, widest: int):
        self.values = values
        self.levels = [np.arange(len(values), dtype=np.int32)]
        span = 1
        while span * 2 <= min(widest, len(values)):
            left, right = self.levels[-1][:-span], self.levels[-1][span:]
            self.levels.append(np.where(values[left] > values[right], left, right))
            span *= 2

    def rightmost(self, low: int, high: int) -> int:
        """Of ``values[low:high]``; ``low < high``."""
        level = (high - low).bit_length() - 1
        left, right = self.levels[level][low], self.levels[level][high - (1 << level)]
        return int(left if self.values[left] > self.values[right] else right)


def split_spans(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """``(start, end)`` of the pieces, which cover the text; an empty text is one empty piece.

    No piece is longer than ``limit``; consecutive pieces share at most
    ``overlap`` characters. Pieces but the last have at least half of the
    limit, so that the search always advances.
    """
    if not 0 <= overlap * 2 < limit:
        raise ValueError("the overlap must be less than half of the limit")
    if len(text) <= limit:
        return [(0, len(text))]
    strength = boundary_strengths(text)
    best = RangeMaximum(strength, limit)
    spans, start = [], 0
    while len(text) - start > limit:
        cut = best.rightmost(start + limit // 2, start + limit + 1)
        spans.append((start, cut))
        # the earliest text that is repeated begins at a boundary too; without one, at the full overlap
        start = best.rightmost(cut - overlap, cut) if overlap else cut
        if overlap and strength[start] < 2:
            start = cut - overlap if strength[cut - overlap] >= 0 else start
    spans.append((start, len(text)))
    return spans


def split_oversized(docs: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """``(id, piece_no, start, end, piece)``, pieces counted from 0, positions in code points.

    Texts within the limit, empty ones included, come out as one piece without
    leaving the JVM; null texts have none. Repeated rows repeat their pieces.
    Extra columns are ignored.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(key, i, a, b, text[a:b]) for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for i, (a, b) in enumerate(split_spans(text, limit, overlap))]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                names=["id", "piece_no", "start", "end", "piece"],
            )

    texts = docs.select("id", "text").where(F.col("text").isNotNull())
    large = texts.where(F.length("text") > limit).mapInArrow(pieces, PIECES)
    small = texts.where(F.length("text") <= limit).select(
        "id", F.lit(0).alias("piece_no"), F.lit(0).cast("bigint").alias("start"), F.length("text").cast("bigint").alias("end"), F.col("text").alias("piece")
    )
    return large.unionByName(small)
