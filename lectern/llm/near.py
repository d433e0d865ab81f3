"""Near-duplicate records: consistent weighted sampling over TF-IDF shingles, banded and verified.

1. Texts are reduced to letters and digits after NFKC; equal ones are one
   class, represented once from here on.
2. Document frequencies of all shingles of all texts are counted into a table
   of fixed size, which gives every shingle its inverse document frequency as
   weight. (Shingles that share a cell share its weight, so that the weight is
   still one function of the shingle.) A term counts by presence.
3. Improved consistent weighted sampling: for each shingle and each round, two
   gamma variates and a uniform one, all functions of the shingle's hash, give
   a quantity whose minimum over a set of shingles is attained at the same
   shingle in two sets with a probability equal to their weighted Jaccard
   similarity. As a weight depends on its shingle alone, the method's second
   component is equal wherever the shingle is. A round spreads the shingles
   over bins, which gives a minimum per bin for one draw per shingle; an empty
   bin takes another bin's minimum, chosen by a hash of its number.
4. Where plain similarity is asked for, the weights are damped to a ratio of
   SPREAD at most. A pair of plain similarity J then has a weighted one of at
   least J / (J + SPREAD (1 - J)), however its common and its own shingles are
   distributed: 0.449 for 0.55.
5. Bands of minima are joined; equal bands make a candidate, which must also
   agree in two sketches of all minima, one bit of each and then four.
6. Candidates are verified with the shingles of both whole texts.

With 48 bands of 3 minima, a pair of plain similarity 0.55 is missed with a
probability of 0.02 % if its weights are of no account, and of 1 % in the worst
case, where all common shingles are the most frequent and all others the
rarest; at 0.6 with 0.001 % and 0.2 %.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.rolling import Rolling, chunks, code_points, mixed
from lectern.session import materialize

SHINGLE, LEAST_CHARS, THRESHOLD = 5, 40, 0.55
BANDS, WIDTH, ROUNDS = 48, 3, 6
BINS = BANDS * WIDTH // ROUNDS
#: The ratio of the largest to the least weight where plain similarity is asked for.
SPREAD = 1.5
#: Of the 144 minima of two texts, so many agree at least in one bit, and so many in four; at a weighted similarity of 0.449, the least for plain 0.55, they do but for one pair in 300,000.
LEAST_BITS, LEAST_NIBBLES = 78, 42
#: Cells of the table of document frequencies: 4 MB, whatever the corpus.
CELLS, PART, BRANCHES = 1 << 20, 1 << 16, 64
BITS, NIBBLES = [f"b{i}" for i in range(3)], [f"n{i}" for i in range(9)]
_APART = re.compile(r"[\W_]+")
_U = np.uint64
_24 = _U((1 << 24) - 1)


def letters_and_digits(text: str) -> str:
    return _APART.sub("", unicodedata.normalize("NFKC", text))


def shingles_of(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``(text, shingle)`` of all shingles of all texts, in the order of the texts."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    grams = Rolling(code_points(texts)).grams(size)
    text = np.repeat(np.arange(len(texts)), lengths)[: len(grams)]
    inside = np.arange(len(grams)) + size <= np.repeat(np.cumsum(lengths), lengths)[: len(grams)]
    return text[inside], grams[inside]


def cells_of(grams: np.ndarray) -> np.ndarray:
    return (grams >> _U(44)).astype(np.int64)


def _draws(grams: np.ndarray, log_weight: np.ndarray, number: int) -> np.ndarray:
    """The logarithm of the quantity that consistent weighted sampling minimizes."""
    x = mixed(grams ^ mixed(np.array([2 * number + 1], _U)))
    y = mixed(x + _U(0x9E3779B97F4A7C15))

    def uniform(bits: np.ndarray) -> np.ndarray:
        return ((bits & _24).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-24)

    r = -np.log(uniform(x) * uniform(x >> _U(24)))
    log_c = np.log(-np.log(uniform(y) * uniform(y >> _U(24))))
    beta = uniform((x >> _U(48)) | ((y >> _U(48)) << _U(16)))
    t = np.floor(log_weight / r + beta)
    return log_c - r * (t - beta) - r


def signatures(texts: int, text: np.ndarray, grams: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The sampled shingles, by text, as 32 bits each; ``texts`` rows of ROUNDS x BINS columns."""
    out = np.empty((texts, ROUNDS * BINS), np.uint32)
    log_weight = np.log(weight).astype(np.float32)
    low = grams & _U(0xFFFFFFFF)
    for number in range(ROUNDS):
        value = _draws(grams, log_weight, number).view(np.uint32)
        # the bits of floats in the order of their values
        value = np.where(value >> np.uint32(31), ~value, value | np.uint32(1 << 31))
        bins = (mixed(grams + _U(number + 101)) % _U(BINS)).astype(np.int64)
        least = np.full(texts * BINS, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least, text * BINS + bins, (value.astype(np.uint64) << _U(32)) | low)
        least = least.reshape(texts, BINS)
        empty = least == np.iinfo(np.uint64).max
        filled = least.copy()
        for attempt in range(4 * BINS):
            if not empty.any():
                break
            step = mixed(np.arange(BINS, dtype=np.uint64) + _U(1000 * (attempt + 1) + number))
            source = (step % _U(BINS)).astype(np.int64)
            filled = np.where(empty, least[:, source], filled)
            empty = filled == np.iinfo(np.uint64).max
        for shift in range(1, BINS):  # what the hashed order has not reached
            if not empty.any():
                break
            filled = np.where(empty, np.roll(least, shift, axis=1), filled)
            empty = filled == np.iinfo(np.uint64).max
        out[:, number * BINS : (number + 1) * BINS] = (filled & _U(0xFFFFFFFF)).astype(np.uint32)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each row; the band's number is part of it."""
    parts = signature.astype(np.uint64).reshape(len(signature), BANDS, WIDTH)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for i in range(WIDTH):
        key = mixed(key * _U(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key.view(np.int64)


def sketches(signature: np.ndarray) -> list[np.ndarray]:
    """One bit of each minimum in three longs, then four of each in nine: equal minima agree, others by chance."""
    out = []
    for bits, names in ((1, 3), (4, 9)):
        low = (signature & np.uint32((1 << bits) - 1)).astype(np.uint64)
        held = low.shape[1] // names
        places = np.arange(held, dtype=np.uint64) * _U(bits)
        out += [(low[:, i * held : (i + 1) * held] << places).sum(axis=1, dtype=np.uint64).view(np.int64) for i in range(names)]
    return out


def _normed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [letters_and_digits(t) for t in batch.column(1).to_pylist()]
        keep = [i for i, t in enumerate(texts) if len(t) >= LEAST_CHARS]
        kept = [texts[i] for i in keep]
        docs = np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in kept], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(docs), pa.array(kept, pa.string())], names=["id", "doc", "text"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CELLS, np.int64)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for a, b in chunks(texts):
            text, grams = shingles_of(texts[a:b])
            cell = text * CELLS + cells_of(grams)
            cell.sort()
            once = cell[np.r_[True, cell[1:] != cell[:-1]]] if len(cell) else cell  # a text counts once for a cell
            counts += np.bincount(once % CELLS, minlength=CELLS)
    branch = TaskContext.get().partitionId() % BRANCHES
    for part in range(CELLS // PART):
        cells = counts[part * PART : (part + 1) * PART]
        if cells.any():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([branch], pa.int32()), pa.array([cells.tobytes()], pa.binary())], names=["part", "branch", "counts"])


def document_frequencies(normed: DataFrame) -> np.ndarray:
    """Texts per cell of shingles, over all texts; the result has CELLS numbers, however many texts there are."""

    def total(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(PART, np.int64)
        for batch in batches:
            for value in batch.column("counts"):
                cells += np.frombuffer(value.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([cells.tobytes()], pa.binary())], names=["part", "counts"])

    # a tree of sums: a task of the first level reads the counts of one branch of the input's partitions
    counted = normed.select("text").mapInArrow(_counted, "part int, branch int, counts binary")
    parts = counted.groupBy("part", "branch").applyInArrow(total, "part int, counts binary").groupBy("part").applyInArrow(total, "part int, counts binary")
    out = np.zeros(CELLS, np.int64)
    for row in parts.collect():
        out[row.part * PART : (row.part + 1) * PART] = np.frombuffer(row.counts, np.int64)
    return out


def inverse_frequencies(counts: np.ndarray) -> np.ndarray:
    """A weight for each cell; the busiest cell stands for the number of texts, so no weight is below log(2)."""
    most = max(int(counts.max(initial=0)), 1)
    return np.log1p(most / np.maximum(counts, 1)).astype(np.float32)


def damped(weights: np.ndarray, spread: float = SPREAD) -> np.ndarray:
    """The weights, in their order, between 1 and ``spread``."""
    return np.float32(1) + np.float32(spread - 1) * weights / max(float(weights.max(initial=0)), 1e-6)


def _agreeing(pairs: DataFrame, signs: DataFrame, columns: list[str], differing: Callable[[Column], Column], least: int) -> DataFrame:
    """The pairs of which at least so many minima agree in the sketch of these columns."""
    sketch = signs.select("doc", *columns).dropDuplicates(["doc"])
    of = lambda side: sketch.select(F.col("doc").alias(f"doc_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in columns))
    apart = sum((differing(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in columns), F.lit(0))
    return pairs.join(of("a"), "doc_a").join(of("b"), "doc_b").where(BANDS * WIDTH - apart >= least).select("doc_a", "doc_b")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, weighted: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``: members has id and doc, the class of equal normalized texts; links has doc_a, doc_b and both similarities.

    Links are pairs of classes whose shingle sets have a Jaccard similarity of
    at least ``threshold``, weighted by TF-IDF if ``weighted``, else plain.
    Null texts and those of fewer than 40 letters and digits are in no class.
    Repeated deliveries of an id are one member. Extra columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select("id", "text").where(F.col("text").isNotNull() & F.col("id").isNotNull())
    normed = materialize(texts.mapInArrow(_normed, "id string, doc bigint, text string"), "normed")
    inverse = inverse_frequencies(document_frequencies(normed))
    weights = spark.sparkContext.broadcast(inverse)
    sampling = weights if weighted else spark.sparkContext.broadcast(damped(inverse))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a task signs a text once, so that copies meet in as few rows as there are tasks
        for batch in batches:
            unique = {doc: text for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if doc not in seen}
            seen |= unique.keys()
            ids, values = np.array(list(unique), np.int64), list(unique.values())
            for a, b in chunks(values):
                # a shingle that a text repeats draws the same again, so the minima are those of the set
                text, grams = shingles_of(values[a:b])
                signature = signatures(b - a, text, grams, sampling.value[cells_of(grams)])
                keys = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * BANDS), pa.array(band_keys(signature).ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b]), keys, *map(pa.array, sketches(signature))], names=["doc", "keys", *BITS, *NIBBLES])

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            plain, heavy = [], []
            for a, b in zip(columns[2], columns[3], strict=True):
                x, y = (np.unique(Rolling(code_points([t])).grams(SHINGLE)) for t in (a, b))
                both = np.intersect1d(x, y, assume_unique=True)
                plain.append(len(both) / (len(x) + len(y) - len(both)))
                wx, wy, wb = (float(weights.value[cells_of(g)].sum(dtype=np.float64)) for g in (x, y, both))
                heavy.append(wb / (wx + wy - wb))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(plain, pa.float64()), pa.array(heavy, pa.float64())], names=["doc_a", "doc_b", "jaccard", "weighted_jaccard"])

    longs = ", ".join(f"{c} bigint" for c in (*BITS, *NIBBLES))
    signs = materialize(normed.select("doc", "text").mapInArrow(signed, f"doc bigint, keys array<bigint>, {longs}"), "signs")
    # a plain join of two shuffled sides: adaptive execution splits the partition of a hot band
    banded = signs.select("doc", F.explode("keys").alias("key"))
    met = banded.withColumnRenamed("doc", "doc_a").join(banded.withColumnRenamed("doc", "doc_b"), "key").where(F.col("doc_a") < F.col("doc_b")).select("doc_a", "doc_b").distinct()
    agreeing = _agreeing(met, signs, BITS, F.bit_count, LEAST_BITS)
    lowest = F.lit(0x1111111111111111).cast("bigint")
    differing = lambda x: F.bit_count((x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseOR(F.shiftrightunsigned(x, 3))).bitwiseAND(lowest))
    candidates = materialize(_agreeing(agreeing, signs, NIBBLES, differing, LEAST_NIBBLES), "candidates")
    wanted = candidates.select(F.col("doc_a").alias("doc")).union(candidates.select(F.col("doc_b").alias("doc"))).distinct()
    representative = normed.join(wanted, "doc", "left_semi").select("doc", "text").dropDuplicates(["doc"])
    sides = materialize(representative, "sides")
    pairs = candidates.join(sides.select(F.col("doc").alias("doc_a"), F.col("text").alias("a")), "doc_a").join(sides.select(F.col("doc").alias("doc_b"), F.col("text").alias("b")), "doc_b")
    measured = pairs.select("doc_a", "doc_b", "a", "b").mapInArrow(verified, "doc_a bigint, doc_b bigint, jaccard double, weighted_jaccard double")
    links = measured.where(F.col("weighted_jaccard" if weighted else "jaccard") >= threshold)
    return normed.select("id", "doc").distinct(), links


def near_pairs(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(id_a, id_b)``, id_a < id_b: all pairs of ids whose texts are near duplicates, copies included."""
    members, links = near_classes(docs, threshold)
    members = materialize(members, "members")
    a, b = members.select(F.col("id").alias("a"), F.col("doc").alias("doc_a")), members.select(F.col("id").alias("b"), F.col("doc").alias("doc_b"))
    across = links.join(a, "doc_a").join(b, "doc_b").select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))
    copied = members.groupBy("doc").agg(F.min("id").alias("x"), F.max("id").alias("y")).where(F.col("x") != F.col("y")).select("doc")
    same = members.join(copied, "doc", "left_semi")
    within = same.withColumnRenamed("id", "id_a").join(same.withColumnRenamed("id", "id_b"), "doc").where(F.col("id_a") < F.col("id_b")).select("id_a", "id_b")
    return across.unionByName(within)


def near_members(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(id, class_id, links)``: each id that has a near duplicate, the least id with an equal normalized text, and the number of other classes its class is linked to.

    Copies alone have 0 links. The rows are as many as ids, however large a group is.
    """
    members, links = near_classes(docs, threshold)
    members, links = materialize(members, "members"), materialize(links.select("doc_a", "doc_b"), "links")
    counts = links.select(F.col("doc_a").alias("doc")).unionAll(links.select(F.col("doc_b").alias("doc"))).groupBy("doc").agg(F.count("*").alias("links"))
    classes = members.groupBy("doc").agg(F.min("id").alias("class_id"), F.count("*").alias("ids"))
    found = classes.join(counts, "doc", "left").where((F.col("ids") > 1) | F.col("links").isNotNull())
    return members.join(found, "doc").select("id", "class_id", F.coalesce("links", F.lit(0)).alias("links"))
