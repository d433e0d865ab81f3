"""Encoding of a corpus with a public byte-level BPE vocabulary, and decoding.

Text is split into words by the vocabulary's pattern, and words into units
where no token of the vocabulary can reach across: for CJK text these are
mostly single characters, so a corpus has few distinct units. The merges of
the distinct units are folded by Spark's higher-order functions over arrays of
bytes, with the ranks as a literal table. The most frequent units and their
ids, bounded in number, are broadcast; documents are encoded by looking up
their words. A unit beyond the bound, or too long for the fold's quadratic
cost, is merged where it is met, by the same ranks.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.session import materialize

TOKENIZERS = "/opt/tokenizers"
#: Units whose ids are broadcast: at most so many, each of at most so many bytes, so less than 64 MB.
MOST_UNITS, UNIT_BYTES = 200_000, 24
_BUCKETS = 8192
#: Fixed value: the pattern that splits text before the merges. White space is the Unicode property, as in the libraries that read the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


@lru_cache(2)
def ranks_of(name: str, folder: str = TOKENIZERS) -> dict[bytes, int]:
    """Pieces and their ranks, which are their ids, from a file in tiktoken's format."""
    with open(f"{folder}/{name}.tiktoken", "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def _characters(piece: bytes) -> list[bytes]:
    """``piece`` cut before each byte that begins a character."""
    cuts = [0, *(i for i in range(1, len(piece)) if piece[i] & 0xC0 != 0x80), len(piece)]
    return [piece[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


class _Kinds(dict):
    """For each character one that stands for all characters that tokens treat alike at their edges."""

    def __init__(self, across: dict[bytes, set[bytes]]):
        super().__init__()
        self._across, self._starts = across, frozenset(x for s in across.values() for x in s)
        self._known: dict[tuple[frozenset[bytes], frozenset[bytes]], str] = {}

    def __missing__(self, code: int) -> str:
        c = chr(code).encode("utf-8", "surrogatepass")
        edges = frozenset(c[i:] for i in range(len(c)) if c[i:] in self._across), frozenset(c[:i] for i in range(1, len(c) + 1) if c[:i] in self._starts)
        if edges not in self._known:
            self._known[edges] = chr(0x4E00 + len(self._known))
        found = self[code] = self._known[edges]
        return found

    def joined(self) -> regex.Pattern:
        """Matches a kind before another one into which a token may reach from it."""
        rules = []
        for (ends, _), a in self._known.items():
            reach = frozenset().union(*(self._across[e] for e in ends))
            if after := "".join(b for (_, starts), b in self._known.items() if not reach.isdisjoint(starts)):
                rules.append(f"{a}(?=[{after}])")
        return re.compile("|".join(rules) or "(?!)")

    def __len__(self) -> int:
        return len(self._known)


class Units:
    """Cuts words where no token can reach from one character into the next."""

    def __init__(self, ranks: dict[bytes, int]):
        # what a token holds of the characters on the two sides of a boundary: whole characters, the end of one or the start of one
        across: dict[bytes, set[bytes]] = {}
        for piece in ranks:
            parts = _characters(piece)
            for a, b in zip(parts, parts[1:], strict=False):
                across.setdefault(a, set()).add(b)
        self._kinds = _Kinds(across)
        self._joined, self._of = re.compile("(?!)"), 0

    def of(self, word: str) -> list[str]:
        if word.isascii():
            return [word]
        kinds = word.translate(self._kinds)
        if len(self._kinds) != self._of:
            self._joined, self._of = self._kinds.joined(), len(self._kinds)
        if not self._joined.search(kinds):
            return list(word)
        joined = {m.end() for m in self._joined.finditer(kinds)}
        cuts = [0, *(i for i in range(1, len(word)) if i not in joined), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def merge(unit: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one unit, by a heap of its possible merges; also fast for very long units."""
    n = len(unit)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(a: int) -> None:
        if 0 <= a and end[a] < n and (rank := ranks.get(unit[a : end[end[a]]])) is not None:
            heapq.heappush(heap, (rank, a, end[end[a]]))

    for a in range(n - 1):
        offer(a)
    while heap:
        _, a, stop = heapq.heappop(heap)
        if not alive[a] or end[a] >= n or end[end[a]] != stop:
            continue
        gone = end[a]
        alive[gone] = False
        end[a] = stop
        if stop < n:
            before[stop] = a
        offer(a)
        offer(before[a])
    return [ranks[unit[a : end[a]]] for a in range(n) if alive[a]]


def _rank_table(ranks: dict[bytes, int]) -> Column:
    """The ranks as one literal, folded once when the plan is optimized: buckets of pieces in hex with their ranks."""
    buckets: list[list[str]] = [[] for _ in range(_BUCKETS)]
    for piece, rank in ranks.items():
        digits = piece.hex().upper()
        buckets[_bucket(digits)].append(f"{digits}:{rank},")
    return F.split(F.lit(";".join("," + "".join(bucket) for bucket in buckets)), ";")


def _bucket(digits: str) -> int:
    """As in _rank: by the piece's length, its first two and its last two bytes."""
    return (len(digits) * 31 + int(digits[:4], 16) * 17 + int(digits[-4:], 16)) % _BUCKETS


def _rank(table: Column, digits: Column) -> Column:
    number = lambda c: F.conv(c, 16, 10).cast("int")
    bucket = F.element_at(table, (F.length(digits) * 31 + number(F.substring(digits, 1, 4)) * 17 + number(F.substring(digits, -4, 4))) % _BUCKETS + 1)
    entry = F.concat(F.lit(","), digits, F.lit(":"))
    at = F.instr(bucket, entry)
    return F.when(at > 0, F.substring_index(F.substring(bucket, at + F.length(entry), F.lit(8)), ",", 1).cast("int"))


def fold_merges(unit: Column, ranks: dict[bytes, int]) -> Column:
    """The ids of each unit: its bytes, folded by merging the neighbours of least rank, leftmost first, until none has a rank."""
    table = _rank_table(ranks)
    digits = F.hex(F.encode(unit, "UTF-8"))
    count = F.length(digits) / 2
    pieces = F.transform(F.sequence(F.lit(0), count.cast("int") - 1), lambda i: F.substring(digits, i * 2 + 1, 2))

    def step(acc: Column, _: Column) -> Column:
        # ranks of the pairs, computed once for each round and carried beside the pieces
        at, p = acc["at"], acc["pieces"]
        joined = F.concat(
            F.slice(p, F.lit(1), at - 1),
            F.array(F.concat(F.element_at(p, at), F.element_at(p, at + 1))),
            F.slice(p, at + 2, F.greatest(F.size(p) - at - 1, F.lit(0))),
        )
        return F.when(at.isNull(), acc).otherwise(F.transform(F.array(joined), lambda q: F.struct(q.alias("pieces"), best(q).alias("at")))[0])

    def best(p: Column) -> Column:
        pairs = F.transform(
            F.when(F.size(p) > 1, F.sequence(F.lit(1), F.size(p) - 1)).otherwise(F.array().cast("array<int>")),
            lambda i: F.struct(_rank(table, F.concat(F.element_at(p, i), F.element_at(p, i + 1))).alias("rank"), i.alias("at")),
        )
        return F.array_min(F.filter(pairs, lambda x: x["rank"].isNotNull()))["at"]

    start = F.transform(F.array(pieces), lambda q: F.struct(q.alias("pieces"), best(q).alias("at")))[0]
    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(count.cast("int") - 1, F.lit(1))), start, step)
    return F.transform(folded["pieces"], lambda p: _rank(table, p))


def _counts(units: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(units), pa.string()), pa.array(list(units.values()), pa.int64())], names=["unit", "n"])


def unit_ids(docs: DataFrame, ranks: dict[bytes, int], most: int = MOST_UNITS) -> dict[str, bytes]:
    """The ids, as little-endian ints, of the ``most`` units that the most distinct words of all texts hold."""
    pattern, cut = regex.compile(PATTERN), Units(ranks)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units: Counter[str] = Counter()
        seen: set[str] = set()
        for batch in batches:
            words = {w for text in batch.column(0).to_pylist() for w in pattern.findall(text)} - seen
            seen |= words
            for word in words:
                units.update(cut.of(word))
            if len(units) > 300_000 or len(seen) > 500_000:
                yield _counts(units)
                units.clear()
                seen.clear()
        yield _counts(units)

    texts = docs.select("text").where(F.col("text").isNotNull())
    units = texts.mapInArrow(counted, "unit string, n bigint").where(F.octet_length("unit") <= UNIT_BYTES).groupBy("unit").agg(F.sum("n").alias("n"))
    frequent = materialize(units.orderBy(F.desc("n"), "unit").limit(most).select("unit"), "units").repartition(docs.sparkSession.sparkContext.defaultParallelism)
    merged = frequent.select("unit", fold_merges(F.col("unit"), ranks).alias("ids"))
    # the plan holds the ranks as literals: the driver keeps a plan's description for every execution, and its nodes' for every change of the plan
    conf, short = docs.sparkSession.conf, {"spark.sql.maxPlanStringLength": "10000", "spark.sql.debug.maxToStringFields": "0"}
    described = {name: conf.get(name) for name in short}
    try:
        for name, value in short.items():
            conf.set(name, value)
        found = merged.toArrow()
    finally:
        for name, value in described.items():
            conf.set(name, value)
    values = found.column("ids").combine_chunks()
    flat, offsets = values.values.to_numpy(), values.offsets.to_numpy()
    return {unit: flat[a:b].astype("<i4").tobytes() for unit, a, b in zip(found.column("unit").to_pylist(), offsets, offsets[1:], strict=False)}


def encode_texts(docs: DataFrame, name: str = "byte_bpe_50k", folder: str = TOKENIZERS, count_only: bool = False) -> DataFrame:
    """``docs`` without ``text`` and with ``ids``, the token ids of each text, or with ``tokens``, their number.

    No special token is used: their strings are ordinary text. Null and empty
    texts give an empty list, or 0. Rows keep their multiplicity and all other
    columns but ones called ids or tokens.
    """
    result = "tokens" if count_only else "ids"
    ranks = ranks_of(name, folder)
    spark = docs.sparkSession
    pattern, cut = regex.compile(PATTERN), Units(ranks)
    shared = spark.sparkContext.broadcast((unit_ids(docs, ranks), ranks))
    kept = [c for c in docs.columns if c not in ("text", result)]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, table = shared.value
        words: dict[str, bytes] = {}

        def ids_of(word: str) -> bytes:
            parts = []
            for unit in cut.of(word):
                ids = units.get(unit)
                parts.append(np.array(merge(unit.encode(), table), "<i4").tobytes() if ids is None else ids)
            out = words[word] = b"".join(parts)
            return out

        for batch in batches:
            rest, lists, total = batch.select(kept), [], 0
            begun = 0

            def packed(begun: int, lists: list[bytes], rest: pa.RecordBatch = rest) -> pa.RecordBatch:
                sizes = np.fromiter((len(x) // 4 for x in lists), np.int32, len(lists))
                if count_only:
                    column = pa.array(sizes.astype(np.int64))
                else:
                    column = pa.ListArray.from_arrays(pa.array(np.r_[np.int32(0), np.cumsum(sizes, dtype=np.int32)]), pa.array(np.frombuffer(b"".join(lists), "<i4")))
                return pa.RecordBatch.from_arrays([*rest.slice(begun, len(lists)).columns, column], names=[*kept, result])

            for i, text in enumerate(batch.column("text").to_pylist()):
                value = b"".join([words.get(w) or ids_of(w) for w in pattern.findall(text)]) if text else b""
                lists.append(value)
                total += len(value)
                if total > 16_000_000:
                    yield packed(begun, lists)
                    begun, lists, total = i + 1, [], 0
            if len(words) > 500_000:
                words.clear()
            yield packed(begun, lists)

    schema = T.StructType([*docs.select(kept).schema.fields, T.StructField(result, T.LongType() if count_only else T.ArrayType(T.IntegerType()))])
    return docs.select(*kept, "text").mapInArrow(encoded, schema)


def decode_ids(ids: Column, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Column:
    """The text of a list of ids: the binary pieces, joined. Null gives null, an empty list an empty text."""
    pieces = sorted((rank, piece.hex()) for piece, rank in ranks_of(name, folder).items())
    table = F.split(F.lit(",".join(digits for _, digits in pieces)), ",")
    return F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(table, i.cast("int") + 1)), "")), "UTF-8")
