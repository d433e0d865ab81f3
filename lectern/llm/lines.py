"""Lines that recur within one source, found with compressed bitmaps of its documents.

Every document has an ordinal within its source. A line, as it is written, has
a bitmap of the documents that hold it, compressed to its words of 64 bits that
are not zero, one row for each. The bitmaps of a line's variants (other digits,
widths or spacing), which share a form, are united word by word. Cardinalities
are exact. A line is removed if its form's bitmap, looked up among those that
reach the threshold, has the document's bit. A hot line is spread over as many
groups as its bitmap has words.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.ordering import numbered
from lectern.session import materialize

MIN_DOCUMENTS = 8
_DIGITS = re.compile("[0-9]+")
_SCHEMA = "source string, id string, line_no bigint, form binary, variant bigint"


def line_form(line: str) -> str:
    """The form in which lines are compared: NFKC, white space joined, runs of digits as one sign."""
    if not line.isascii():
        line = unicodedata.normalize("NFKC", line)
    return _DIGITS.sub("0", " ".join(line.split()))


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest, short = xxhash.xxh3_128_digest, xxhash.xxh3_64_intdigest
    for batch in batches:
        rows, numbers, forms, variants = [], [], [], []
        for row, text in enumerate(batch.column(2).to_pylist()):
            for number, line in enumerate(text.split("\n"), 1):
                if form := line_form(line):
                    rows.append(row), numbers.append(number)
                    forms.append(digest(form.encode("utf-8", "surrogatepass"))), variants.append(short(line.encode("utf-8", "surrogatepass")))
        at = pa.array(rows, pa.int64())
        columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(numbers, pa.int64()), pa.array(forms, pa.binary()), pa.array(np.array(variants, np.uint64).view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["source", "id", "line_no", "form", "variant"])


def bit_of(number: Column) -> tuple[Column, Column]:
    """The word of a bitmap that a number falls into, and its bit there."""
    return F.shiftright(number, 6), F.call_function("shiftleft", F.lit(1).cast("bigint"), (number % 64).cast("int"))


def repeated_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``(id, line_no)`` of each line whose form is in ``min_documents`` or more documents of its source.

    ``docs`` has id, source_stem and text. Documents are distinct by id; their
    ordinals are the ranks of their ids within the source, so further
    deliveries of an id set the same bit. Null ids, texts and sources, blank
    lines and empty tables give no rows; extra columns are ignored.
    """
    rows = docs.where(F.col("text").isNotNull() & F.col("source_stem").isNotNull() & F.col("id").isNotNull())
    lines = materialize(rows.select("source_stem", "id", "text").mapInArrow(_forms, _SCHEMA), "lines")
    # fewer rows than documents asked for can't reach the threshold: only the rest gets bitmaps
    often = lines.groupBy("source", "form").agg(F.count("*").alias("n")).where(F.col("n") >= min_documents).select("source", "form")
    ranked = numbered(rows.select(F.col("source_stem").alias("source"), "id").distinct(), "source", "id", name="rank")
    first = ranked.groupBy("source").agg(F.min("rank").alias("first"))
    ordinals = ranked.join(first, "source").select("source", "id", (F.col("rank") - F.col("first")).alias("ordinal"))
    word, bit = bit_of(F.col("ordinal"))
    held = lines.join(often, ["source", "form"], "left_semi").join(ordinals, ["source", "id"]).select("source", "form", "variant", "id", "line_no", word.alias("word"), bit.alias("bit"))
    held = materialize(held, "held")
    bitmaps = held.groupBy("source", "form", "variant", "word").agg(F.bit_or("bit").alias("bits"))
    united = bitmaps.groupBy("source", "form", "word").agg(F.bit_or("bits").alias("bits"))
    passed = united.groupBy("source", "form").agg(F.sum(F.bit_count("bits")).alias("n")).where(F.col("n") >= min_documents).select("source", "form")
    kept = united.join(passed, ["source", "form"], "left_semi")
    return held.join(kept, ["source", "form", "word"]).where(F.col("bits").bitwiseAND(F.col("bit")) != 0).select("id", "line_no").distinct()


def remove_lines(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the lines of ``found`` taken out of ``text``, looked up in a bitmap of line numbers; documents without such lines are unchanged."""
    word, bit = bit_of(F.col("line_no"))
    words = found.groupBy(F.col("id").alias("_lectern_gone_id"), word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    gone = words.groupBy("_lectern_gone_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("_lectern_gone_lines"))
    is_gone = "(coalesce(_lectern_gone_lines[shiftright(i + 1L, 6)], 0L) & shiftleft(1L, int((i + 1) % 64))) != 0"
    kept = F.expr(f"array_join(filter(split(text, '\n'), (x, i) -> not ({is_gone})), '\n')")
    return (
        docs.join(gone, F.col("id") == F.col("_lectern_gone_id"), "left")
        .withColumn("text", F.when(F.col("_lectern_gone_id").isNull(), F.col("text")).otherwise(kept))
        .drop("_lectern_gone_id", "_lectern_gone_lines")
    )
