"""Long exact spans shared between records.

A de Bruijn graph of the corpus, sampled by minimizers so that it has about
one node per 25 characters: a node is the k-mer of least hash in a window, an
edge is the stretch around it up to where the next k-mer takes over. As k-mer
and window together have exactly the least length of a span, every stretch of
that length has one node, chosen by its content alone, so equal stretches meet
at equal nodes wherever they stand.

Nodes held by one record are dropped. An edge that two records hold is a
repeated path as it is; one that follows a branching node may still agree in a
part of its stretches. For those, the source coordinates lead back to the
text, one occurrence for each different edge, and the stretches are compared.
Repeated nonbranching paths, which are runs of edges in a record, are then
joined with the records and compacted to maximal spans.

All groups are aggregated map-side before they are shuffled; nothing is paired
within a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.rolling import Rolling, chunks, code_points
from lectern.session import materialize

LEAST = 80
_LOW = np.uint64(0xFFFFFFFF)


def _kmer(least: int) -> int:
    """The node's length: windows of at most 62 k-mers fit in the bits of a long."""
    return max(least - 61, least * 2 // 5, 1)


def minimizer_edges(texts: list[str], least: int = LEAST) -> tuple[np.ndarray, ...]:
    """``(text, start, windows, node, edge)`` of each edge: ``windows`` stretches of ``least`` characters from ``start`` on have that node."""
    k = _kmer(least)
    w = least - k + 1
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    points = code_points(texts)
    nodes = Rolling(points, 1).grams(k)
    if len(nodes) < w:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.int64),) * 2
    # the upper half of the hash, then the position: ties go to the left, which depends on the content alone
    key = (nodes & ~_LOW) | np.arange(len(nodes), dtype=np.uint64)
    span, low = 1, key
    while span * 2 <= w:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    n = len(key) - w + 1
    at = (np.minimum(low[:n], low[w - span :][:n]) & _LOW).astype(np.int64)
    inside = np.flatnonzero(np.arange(n) + least <= np.repeat(ends, lengths)[:n])
    at = at[inside]
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1)]) if len(at) else np.zeros(0, np.int64)
    windows = np.diff(np.r_[first, len(at)])
    start = inside[first]
    edge = Rolling(points, 0).stretches(start, windows + (least - 1))
    text = np.searchsorted(ends, start, side="right")
    return text, start - (ends - lengths)[text], windows, nodes[at[first]].view(np.int64), edge.view(np.int64)


def shared_spans(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(id, span_start, span_end)``: maximal runs of characters that lie in ``least`` or more consecutive ones found in a record of another id.

    Positions are code points from 0, the end is exclusive. Deliveries of one
    id hold the same text and never share with each other. Null ids, and null,
    empty and shorter texts share nothing; extra columns are ignored.
    """

    def edges_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("id")
            for a, b in chunks(texts):
                text, *columns = minimizer_edges(texts[a:b], least)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(text + a)), *map(pa.array, columns)], names=["id", "start", "windows", "node", "edge"])

    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                grams = Rolling(code_points([text]), 0).grams(least).view(np.int64)
                starts, counts = (np.array([x[c] for x in wanted], np.int64) for c in ("start", "windows"))
                which = np.repeat(np.arange(len(wanted)), counts)
                step = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
                columns = [np.array([x[c] for x in wanted], np.int64)[which] for c in ("node", "edge", "low", "high")]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*columns, step, grams[starts[which] + step])], names=["node", "edge", "low", "high", "step", "gram"])

    texts = docs.select("id", "text").where(F.col("id").isNotNull() & (F.length("text") >= least))
    edges = materialize(texts.mapInArrow(edges_of, "id string, start bigint, windows bigint, node bigint, edge bigint"), "edges")
    doc = F.xxhash64("id")
    nodes = (
        edges.groupBy("node")
        .agg(F.min(doc).alias("low"), F.max(doc).alias("high"), F.min("edge").alias("a"), F.max("edge").alias("b"))
        .where(F.col("low") != F.col("high"))
        .select("node", (F.col("a") != F.col("b")).alias("branching"))
    )
    held = materialize(edges.join(nodes, "node"), "held")
    distinct_edges = held.groupBy("node", "edge", "branching", "windows").agg(F.min(doc).alias("low"), F.max(doc).alias("high"), F.min(F.struct("id", "start")).alias("at"))
    whole = distinct_edges.where(F.col("low") != F.col("high")).select("node", "edge", F.lit(-1).cast("bigint").alias("mask"))
    wanted = (
        distinct_edges.where("branching")
        .groupBy("at.id")
        .agg(F.collect_list(F.struct("node", "edge", "low", "high", "windows", F.col("at.start").alias("start"))).alias("wanted"))
    )
    windows = materialize(
        texts.join(wanted, "id").select("text", "wanted").mapInArrow(windows_of, "node bigint, edge bigint, low bigint, high bigint, step bigint, gram bigint"),
        "windows",
    )
    repeated = windows.groupBy("node", "gram").agg(F.min("low").alias("low"), F.max("high").alias("high")).where(F.col("low") != F.col("high")).select("node", "gram")
    part = windows.join(repeated, ["node", "gram"], "left_semi").groupBy("node", "edge").agg(F.bit_or(F.expr("shiftleft(1L, int(step))")).alias("mask"))
    masks = whole.unionByName(part).groupBy("node", "edge").agg(F.bit_or("mask").alias("mask"))
    stretches = held.join(masks, ["node", "edge"]).select(
        "id",
        F.inline(
            F.when(F.col("mask") == -1, F.array(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("windows") + (least - 1)).alias("b")))).otherwise(
                F.expr(f"transform(filter(sequence(0L, windows - 1), i -> (shiftright(mask, int(i)) & 1L) = 1L), i -> struct(start + i as a, start + i + {least}L as b))")
            )
        ),
    )
    by_start = Window.partitionBy("id").orderBy("a", "b")
    reach = F.max("b").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(reach >= F.col("a"), 0).otherwise(1)
    runs = stretches.distinct().withColumn("apart", apart).withColumn("run", F.sum("apart").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("id", "run").agg(F.min("a").alias("span_start"), F.max("b").alias("span_end")).drop("run")


def shared_share(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``(id, shared_chars, share)`` of every id: how much of its text is shared elsewhere."""
    sums = spans.groupBy("id").agg(F.sum(F.col("span_end") - F.col("span_start")).alias("shared_chars"))
    sizes = docs.groupBy("id").agg(F.max(F.length("text")).alias("size"))
    shared = F.coalesce("shared_chars", F.lit(0))
    return sizes.join(sums, "id", "left").select("id", shared.alias("shared_chars"), F.when(F.col("size") > 0, shared / F.col("size")).otherwise(0.0).alias("share"))
