"""Reading books and the engine's tables; writing them so that readers never see a half."""

from __future__ import annotations

import re
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.sections import SECTION_ROW

TOPIC = re.compile(r"^[a-zA-Z0-9][a-zA-Z0-9._-]*$")
_CONFLICT = "id string, node_id string, claim_a struct<source:string,text:string>, claim_b struct<source:string,text:string>, equivalent_hint boolean, inline_tag string"


class NoSources(ValueError):
    """A topic has no books to read, or no valid name."""


def valid_topic(topic: str) -> str:
    if not TOPIC.match(topic) or ".." in topic:
        raise NoSources(f"not a topic name: {topic!r}")
    return topic


def books(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """``(path, stem, sha256, bytes, chars, physical_lines, text)`` of the topic's Markdown files, but hidden and compiled ones.

    Only the topic's own folder is listed; empty files are passed over. Bytes that are no valid UTF-8 raise.
    """
    name = F.substring_index("path", "/", -1)
    compiled = name.rlike(r"\.(?:zh|en)\.md$|^compiled.*\.md$|^\.") | name.isin(f"{topic}.md", f"{topic}.hk.md")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").option("recursiveFileLookup", "false").load(f"{root}/{valid_topic(topic)}")
    text = F.when(F.expr("is_valid_utf8(content)"), F.decode("content", "UTF-8")).otherwise(F.raise_error(F.concat(F.lit("not UTF-8: "), name)))
    rows = files.where(~compiled).select(
        F.translate("path", "\\", "/").alias("path"), F.regexp_replace(name, r"\.md$", "").alias("stem"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"), text.alias("text"), F.col("modificationTime").alias("modified")
    )
    return rows.select("path", "stem", "sha256", "bytes", F.length("text").cast("bigint").alias("chars"), line_count(F.col("text")).alias("physical_lines"), "text", "modified")


def line_count(text: Column) -> Column:
    """Lines of a text; the last one needs no line end."""
    return F.when(text == "", 0).otherwise(F.regexp_count(text, F.lit("\n")) + F.when(text.endswith("\n"), 0).otherwise(1)).cast("bigint")


def required(found: DataFrame) -> DataFrame:
    if found.isEmpty():
        raise NoSources("no books")
    return found


def changed_only(found: DataFrame, manifest: DataFrame, version: str) -> DataFrame:
    """The books that a manifest of earlier runs doesn't have with this content and this version of the rules."""
    done = manifest.where(F.col("version") == version).select("stem", "sha256").distinct()
    return found.join(done, ["stem", "sha256"], "left_anti")


def read_sections(spark: SparkSession, folder: str) -> DataFrame:
    """Section files of JSON arrays, with ``ord``, the place within the file, and the file's name; files are in the order of their names."""
    files = spark.read.text(f"{folder}/*.sections.json", wholetext=True).select(F.input_file_name().alias("file"), F.from_json("value", f"array<struct<{', '.join(f.replace(' ', ': ', 1) for f in SECTION_ROW.split(', '))}>>").alias("rows"))
    return files.select("file", F.posexplode("rows").alias("ord", "s")).select("s.*", "file", "ord")


def read_conflicts(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; blank and invalid ones are skipped."""
    return spark.read.schema(_CONFLICT).option("mode", "DROPMALFORMED").json(path)


def read_token_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("chars_out double, output_tokens double").option("mode", "PERMISSIVE").json(path)


def has_table(spark: SparkSession, path: str) -> bool:
    """True where a table has been written and committed."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def publish(df: DataFrame, path: str, format: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Writes beside the target and renames: the old table stays whole until the new one is complete. Between the two renames there is no table; a reader that finds none tries again."""
    spark = df.sparkSession
    staged = f"{path}.partial-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.format(format).save(staged)
    paths = spark._jvm.org.apache.hadoop.fs.Path
    target = paths(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    old = paths(f"{path}.old-{uuid.uuid4().hex}")
    if fs.exists(target):
        fs.rename(target, old)
    if not fs.rename(paths(staged), target):
        fs.rename(old, target)
        raise OSError(f"could not publish {path}")
    fs.delete(old, True)


def append_rows(df: DataFrame, path: str) -> None:
    """JSON lines added to a table, such as conflicts or token samples; a job's files appear together when it commits."""
    df.write.mode("append").json(path)


def reset_rows(df: DataFrame, path: str) -> None:
    """The table with these rows only, so that a rerun repeats nothing."""
    df.write.mode("overwrite").json(path)


def publish_texts(texts: dict[str, str], folder: str) -> None:
    """Small finished documents, all staged before the first is renamed."""
    root = Path(folder)
    root.mkdir(parents=True, exist_ok=True)
    staged = []
    for name, text in texts.items():
        partial = root / f"{name}.partial"
        partial.write_text(text, encoding="utf-8", newline="\n")
        staged.append((partial, root / name))
    for partial, final in staged:
        partial.replace(final)
