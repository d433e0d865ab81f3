"""MinHash signatures, overlap pairs, duplicate components, and similarity of paragraphs."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import content_hash
from lectern.operators.components import connected_components
from lectern.session import materialize

#: Results must equal those of signatures made elsewhere with them.
SLOTS, SEED, SHINGLE, LEAST_CHARS = 128, 0xC0FFEE, 5, 40
EXACTISH, OVERLAP = 0.90, 0.55
#: So many different characters at most have shingles that are exact as one 64-bit number.
_KINDS = 7131
_EMPHASIS, _NOT_WORD = re.compile(r"[*_`]+"), re.compile(r"[^\w一-鿿]+")


def normalized(text: str) -> str:
    return _NOT_WORD.sub("", _EMPHASIS.sub("", unicodedata.normalize("NFKC", text)))


@lru_cache(1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    words = np.array([struct.unpack(">II", hashlib.sha256(struct.pack(">II", SEED, i)).digest()[:8]) for i in range(SLOTS)], np.uint64)
    return (words[:, 0] | np.uint64(1)).astype(np.uint32), words[:, 1].astype(np.uint32)


class Signer:
    """Signatures of texts; ``of`` remembers hashes of shingles, up to a bound, ``many`` hashes each shingle of up to a thousand texts once."""

    def __init__(self, remembered: int = 1 << 20):
        self._hashes: dict[str, int] = {}
        self._bound = remembered

    def of(self, text: str | None) -> np.ndarray | None:
        """128 minima, or null for a text of fewer than 40 characters or without a shingle."""
        if text is None or len(text) < LEAST_CHARS:
            return None
        return self._long(normalized(text))

    def _long(self, words: str) -> np.ndarray | None:
        shingles = {words[i : i + SHINGLE] for i in range(len(words) - SHINGLE + 1)}
        if not shingles:
            return None
        if len(self._hashes) > self._bound:
            self._hashes.clear()
        known, seed = self._hashes, struct.pack(">I", SEED)
        for shingle in [x for x in shingles if x not in known]:
            known[shingle] = int.from_bytes(hashlib.sha256(seed + shingle.encode("utf-8", "surrogatepass")).digest()[:4], "big")
        return self._least(np.fromiter((known[s] for s in shingles), np.uint32, len(shingles)))

    def many(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """``of`` each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        words = [(i, n) for i, t in enumerate(texts) if t is not None and len(t) >= LEAST_CHARS and len(n := normalized(t)) >= SHINGLE]
        begun, chars = 0, 0
        for end, (_, n) in enumerate(words, 1):
            chars += len(n)
            if chars >= 1 << 19 or end == len(words):
                self._signed(words[begun:end], out)
                begun, chars = end, 0
        return out

    def _signed(self, words: list[tuple[int, str]], out: list[np.ndarray | None]) -> None:
        joined = "".join(n for _, n in words)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        used = np.zeros(0x110000, np.int64)
        used[codes] = 1
        if (kinds := int(used.sum())) > _KINDS:
            if len(words) == 1:
                out[words[0][0]] = self._long(joined)
            else:
                self._signed(words[: len(words) // 2], out)
                self._signed(words[len(words) // 2 :], out)
            return
        ranks = (np.cumsum(used) - 1).astype(np.uint64)[codes]
        grams, count = np.zeros(len(codes) - SHINGLE + 1, np.uint64), len(codes) - SHINGLE + 1
        for i in range(SHINGLE):
            grams = grams * np.uint64(kinds) + ranks[i : i + count]
        _, first, which = np.unique(grams, return_index=True, return_inverse=True)
        seed = struct.pack(">I", SEED)
        digests = b"".join([hashlib.sha256(seed + joined[i : i + SHINGLE].encode("utf-8", "surrogatepass")).digest()[:4] for i in first.tolist()])
        hashes = np.frombuffer(digests, ">u4").astype(np.uint32)[which]
        at = 0
        for i, n in words:
            out[i] = self._least(hashes[at : at + len(n) - SHINGLE + 1])
            at += len(n)

    @staticmethod
    def _least(x: np.ndarray) -> np.ndarray:
        a, b = _permutations()
        least = np.full(SLOTS, 0xFFFFFFFF, np.uint32)
        for part in np.array_split(x, len(x) // 4096 + 1):  # bounds the product's memory for very long texts
            values = a[:, None] * part  # 32 bits wrap, as the permutations do
            values += b[:, None]
            least = np.minimum(least, values.min(axis=1))
        return least.astype(np.int64)


def signatures(docs: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """``(key, signature)``, a null signature for texts too short; Arrow batches, nothing shuffled."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer()
        for batch in batches:
            values = signer.many(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.list_(pa.int64()))], names=[key, "signature"])

    return docs.select(key, text).mapInArrow(signed, _with(docs.select(key), "signature array<bigint>"))


def _with(df: DataFrame, more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), more])


def estimated_jaccard(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(SLOTS))


def shingle_set(text: Column) -> Column:
    """Distinct 5-character shingles of a normalized text, empty if it is shorter."""
    last = F.length(text) - (SHINGLE - 1)
    return F.when(last > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(SHINGLE))))).otherwise(F.array().cast("array<string>"))


def exact_jaccard(a: Column, b: Column) -> Column:
    """Of two arrays taken as sets; two empty ones have 0."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def _keys(signature: np.ndarray, size: int, chosen: int) -> np.ndarray:
    """The keys of each row: 32 bits of each choice of ``chosen`` slots within blocks of ``size``, with the choice's number above them."""
    out = []
    for block in range(0, SLOTS, size):
        for slots in itertools.combinations(range(block, block + size), chosen):
            key = np.zeros(len(signature), np.uint64)
            for slot in slots:
                key = key * np.uint64(0x9E3779B97F4A7C15) + signature[:, slot].astype(np.uint32)
                key ^= key >> np.uint64(29)
                key *= np.uint64(0xBF58476D1CE4E5B9)
                key ^= key >> np.uint64(32)
            out.append((key & np.uint64(0xFFFFFFFF)) | np.uint64(len(out) << 32))
    return np.stack(out, axis=1).view(np.int64)


def _sharing(signed: DataFrame, least: float) -> DataFrame:
    """``(x, y)``, x < y, of the numbers of all rows whose signatures can agree in ``least`` of the slots, and of few others.

    Slots are cut into blocks. Of a block of s slots all choices of k are keys;
    where c of its slots agree, at least c - (k - 1) of the keys do. So of a
    pair with n equal slots at least n - blocks x (k - 1) keys agree: 7 of 128
    at 0.55 (71 slots, 32 blocks of 4, choices of 3) and 4 of 16 at 0.9 (116
    slots, 16 blocks of 8). Keys that agree by chance only add to the count.
    """
    agreeing = math.ceil(least * SLOTS)
    size, chosen = (8, 8) if least >= EXACTISH else (4, 3)
    shared = agreeing - SLOTS // size * (chosen - 1)
    if shared < 1:
        raise ValueError("pairs that agree in half of the slots or fewer need not share a key")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begun in range(0, batch.num_rows, 512):  # bounds the keys that are in memory
                part = batch.slice(begun, 512)
                keys = _keys(part.column(1).flatten().to_numpy().reshape(-1, SLOTS), size, chosen)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column(0).to_numpy(), keys.shape[1])), pa.array(keys.ravel())], names=["no", "key"])

    keys = signed.select("no", "signature").mapInArrow(keyed, "no bigint, key bigint")
    # a plain join of two shuffled sides: adaptive execution splits the partition of a hot key
    met = keys.withColumnRenamed("no", "x").join(keys.withColumnRenamed("no", "y"), "key").where(F.col("x") < F.col("y"))
    return met.groupBy("x", "y").agg(F.count("*").alias("shared")).where(F.col("shared") >= shared).select("x", "y")


def overlap_pairs(docs: DataFrame, key: str = "id", text: str = "text", least: float = OVERLAP) -> DataFrame:
    """``(a, b, jaccard, content_hash_equal, relation)`` of pairs with equal content or an estimated similarity of at least ``least``.

    Lossless for what ``_sharing`` says, so for any ``least`` above one half.
    Rows of equal content are one class with one signature; pairs are made of
    classes, each by its first row that is long enough to have the signature, and
    of each row of a class with the class's first row, so that a class of n rows
    gives n-1 pairs instead of n squared. ``jaccard`` is 0 where
    a text has no signature. Of unequal deliveries of an id the one whose text
    has the least hash counts.
    """
    rows = docs.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("text")).withColumn("mark", F.xxhash64("text"))
    each = rows.select("id", "mark", content_hash(F.col("text")).alias("hash"), (F.length("text") >= LEAST_CHARS).alias("long"))
    hashed = materialize(each.groupBy("id").agg(F.min(F.struct("mark", "hash", "long")).alias("row")).select("id", "row.hash", "row.long"), "hashed")
    firsts = hashed.groupBy("hash").agg(F.min("id").alias("first"), F.min(F.when(F.col("long"), F.col("id"))).alias("signs"))

    def signing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer()
        for batch in batches:
            values = signer.many(batch.column("text").to_pylist())
            slots = pa.array([None if v is None else v.astype(np.uint32).view(np.int32) for v in values], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.select(["no", "id", "mark"]).columns, slots], names=["no", "id", "mark", "slots"])

    # ids go by their hashes; signatures are shuffled by them once, and all joins read that one shuffle, as long as what is below it is the same for all:
    # hence the conditions, which some of the joins would put there
    numbered = rows.select(F.xxhash64("id").alias("no"), "id", "mark", "text")
    all_signed = numbered.mapInArrow(signing, _with(numbered.drop("text"), "slots array<int>")).where(F.col("no").isNotNull() & F.col("id").isNotNull())
    by_number = all_signed.repartition("no").groupBy("no", "id").agg(F.min(F.struct("mark", "slots")).getField("slots").alias("signature"))
    signed = by_number.join(firsts.where(F.col("signs").isNotNull()).select(F.xxhash64("signs").alias("no")), "no", "left_semi").where(F.col("signature").isNotNull())
    near = (
        _sharing(signed, least)
        .join(signed.select(F.col("no").alias("x"), F.col("id").alias("i"), F.col("signature").alias("p")), "x")
        .join(signed.select(F.col("no").alias("y"), F.col("id").alias("j"), F.col("signature").alias("q")), "y")
        .select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"), estimated_jaccard(F.col("p"), F.col("q")).alias("jaccard"), F.lit(False).alias("content_hash_equal"))
        .where(F.col("jaccard") >= least)
    )
    has = signed.select(F.col("id").alias("a"), F.when(F.size("signature") > 0, 1.0).alias("jaccard"))
    same = hashed.join(firsts, "hash").where(F.col("id") != F.col("first")).select(F.col("first").alias("a"), F.col("id").alias("b"))
    equal = same.join(has, "a", "left").select("a", "b", F.coalesce("jaccard", F.lit(0.0)).alias("jaccard"), F.lit(True).alias("content_hash_equal"))
    return near.unionByName(equal).withColumn("relation", F.when(F.col("content_hash_equal") | (F.col("jaccard") >= EXACTISH), "exactish").otherwise("overlap"))


def duplicate_components(docs: DataFrame, pairs: DataFrame, key: str = "id", size: str = "char_count") -> DataFrame:
    """``(id, canonical, members)`` of the components of exactish pairs; canonical is the longest row, ties by id. ``members`` is their number."""
    groups = connected_components(pairs.where(F.col("relation") == "exactish"), "a", "b")
    sizes = docs.groupBy(F.col(key).alias("node")).agg(F.max(size).alias("size"))
    best = groups.join(sizes, "node").groupBy("component").agg(F.min(F.struct(-F.coalesce("size", F.lit(0)), "node")).getField("node").alias("canonical"), F.count("*").alias("members"))
    return groups.join(best, "component").select(F.col("node").alias("id"), "canonical", "members")


def dominant_stem_pair(docs: DataFrame, pairs: DataFrame, key: str = "id", stem: str = "source_stem", text: str = "text") -> DataFrame:
    """The two stems with most exactish pairs between them, ties to the greater pair: one row, ``(stem_a, stem_b, pairs)``, or none.

    Counts all pairs of rows: those of ``overlap_pairs`` stand for the pairs of
    all rows of a class, and of all rows of two classes that have signatures.
    Products of the classes' rows by stem give their number without listing
    them. Of unequal deliveries of an id the one counts that ``overlap_pairs`` takes.
    """
    exactish = pairs.where(F.col("relation") == "exactish")
    equal = F.col("content_hash_equal")
    ends = exactish.select(F.col("a").alias("k"), F.col("a").alias("of")).unionAll(exactish.select(F.col("b").alias("k"), F.when(equal, F.col("a")).otherwise(F.col("b")).alias("of")))
    classes = ends.groupBy("k").agg(F.min("of").alias("class"))
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.struct(F.xxhash64(text), F.col(stem).alias("s"), (F.length(text) >= LEAST_CHARS).alias("long")).alias("row"))
    held = classes.join(rows.groupBy("k").agg(F.min("row").alias("row")), "k").where(F.col("row.s").isNotNull())
    held = materialize(held.groupBy("class", F.col("row.s").alias("s")).agg(F.count("*").alias("n"), F.count_if("row.long").alias("signed")), "held")
    x, y = (held.select(F.col("class").alias(c), F.col("s").alias(f"s{c}"), F.col("n").alias(f"n{c}"), F.col("signed").alias(f"signed{c}")) for c in "xy")
    within = x.join(y, F.col("x") == F.col("y")).where(F.col("sx") < F.col("sy")).select("sx", "sy", (F.col("nx") * F.col("ny")).alias("n"))
    near = exactish.where(~equal).join(classes.select(F.col("k").alias("a"), F.col("class").alias("p")), "a").join(classes.select(F.col("k").alias("b"), F.col("class").alias("q")), "b")
    near = near.select(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")).distinct()
    between = near.join(x, "x").join(y, "y").where(F.col("sx") != F.col("sy")).select("sx", "sy", (F.col("signedx") * F.col("signedy")).alias("n"))
    counts = within.unionAll(between).where(F.col("n") > 0).groupBy(F.least("sx", "sy").alias("stem_a"), F.greatest("sx", "sy").alias("stem_b")).agg(F.sum("n").alias("pairs"))
    return counts.orderBy(F.desc("pairs"), F.desc("stem_a"), F.desc("stem_b")).limit(1)


def novel_paragraphs(parts: list[str], canonical: list[str], most: float = EXACTISH) -> list[str]:
    """Those of ``parts`` less similar than ``most`` to every canonical paragraph."""
    signer = Signer()
    known = [(signer.of(p), p) for p in canonical]

    def similar(a: str, b: tuple[np.ndarray | None, str]) -> float:
        x, y = signer.of(a), b[0]
        if x is not None and y is not None:
            return float((x == y).mean())
        p, q = ({n[i : i + SHINGLE] for i in range(len(n) - SHINGLE + 1)} for n in (normalized(a), normalized(b[1])))
        return len(p & q) / len(p | q) if p | q else float(normalized(a) == normalized(b[1]))

    return [p for p in parts if all(similar(p, q) < most for q in known)]
