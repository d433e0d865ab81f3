"""Heading rows, keyword buckets, and packing of headings under a token cap."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.budget import estimate_tokens
from lectern.functions.text import excerpt
from lectern.operators.ordering import blocked, plain

#: Buckets in order, and the substrings of a heading path that put it there.
LEXICON = {
    "eyes": ["眼", "瞳孔", "眨眼", "目光", "视线"], "brows": ["眉"], "nose": ["鼻"], "mouth": ["嘴", "唇", "舌", "牙"], "chin": ["下巴", "颏"],
    "smile": ["笑", "微笑"], "micro": ["微表情", "微反应"], "hands": ["手", "掌", "指"], "arms": ["臂", "肩"],
    "legs": ["腿", "脚", "足", "坐姿", "站姿", "走"], "voice": ["声", "语速", "音调", "说话"], "lie": ["谎", "测谎", "欺骗"],
    "emotion_basic": ["惊讶", "厌恶", "愤怒", "恐惧", "悲伤", "愉悦", "轻蔑"], "workplace": ["职场", "面试", "上司", "客户"], "quiz": ["心理测试"],
}
HEADING_TOKENS, CHARS_PER_TOKEN = 24000, 1.5


def merged_lexicon(extra: dict[str, list[str]] | None = None) -> dict[str, list[str]]:
    """The built-in buckets with more patterns and buckets appended, order kept, each pattern once."""
    out = {bucket: list(patterns) for bucket, patterns in LEXICON.items()}
    for bucket, patterns in (extra or {}).items():
        known = out.setdefault(bucket, [])
        known.extend(p for p in dict.fromkeys(patterns) if p not in known)
    return out


def lexicon_hash(lexicon: dict[str, list[str]]) -> str:
    return hashlib.sha256(json.dumps(lexicon, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def lexicon_rows(spark: SparkSession, lexicon: dict[str, list[str]]) -> DataFrame:
    rows = [(i, bucket, j, pattern) for i, (bucket, patterns) in enumerate(lexicon.items()) for j, pattern in enumerate(patterns)]
    return spark.createDataFrame(rows, "bucket_ord int, bucket string, pat_ord int, pattern string")


def keywords(path: Column, lexicon: dict[str, list[str]]) -> Column:
    """The buckets of which a pattern occurs in the heading path, in the lexicon's order; one literal expression, no join."""
    joined = F.array_join(path, "")
    hits = [F.when(F.exists(F.array(*map(F.lit, patterns)), lambda p: F.contains(joined, p)), F.lit(bucket)) for bucket, patterns in lexicon.items() if patterns]
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def primary_bucket(path: Column, lexicon: dict[str, list[str]]) -> Column:
    return F.coalesce(F.try_element_at(keywords(path, lexicon), F.lit(1)), F.lit("other"))


def heading_rows(sections: DataFrame, lexicon: dict[str, list[str]]) -> DataFrame:
    """One row for each section: path, buckets, excerpt, size and kind."""
    return sections.select(
        F.col("id").alias("section_id"), "heading_path", keywords(F.col("heading_path"), lexicon).alias("keywords"), excerpt(F.col("text")).alias("excerpt"), "char_count", "kind"
    )


def bucket_counts(headings: DataFrame, lexicon: dict[str, list[str]]) -> DataFrame:
    """``(bucket, position, rows)``: the lexicon's order, then other, then any further bucket by name."""
    order = {bucket: i for i, bucket in enumerate(lexicon)}
    place = F.create_map(*[x for bucket, i in order.items() for x in (F.lit(bucket), F.lit(i))])
    counts = headings.groupBy(primary_bucket(F.col("heading_path"), lexicon).alias("bucket")).agg(F.count("*").alias("rows"))
    return counts.withColumn("position", F.coalesce(F.try_element_at(place, F.col("bucket")), F.when(F.col("bucket") == "other", len(order)).otherwise(len(order) + 1)))


def heading_line(stem: Column, path: Column, keys: Column, cut: Column) -> Column:
    return F.concat_ws("|", stem, F.array_join(path, ">"), F.array_join(keys, ","), cut)


def packed_headings(rows: DataFrame, group: str, order: str, line: str, cap: int = HEADING_TOKENS, chars_per_token: float = CHARS_PER_TOKEN, block: int = 4096) -> DataFrame:
    """``rows`` with ``pack``, a greedy packing in order under a cap of tokens for each pack.

    The sum starts anew with each pack, which no window frame can say, so the
    sizes of a block of rows are folded in one aggregate; blocks are cut by row
    number, so that a group of any size is never gathered in one row. Packs do
    not cross blocks: a group of many rows gets a few more packs than one fold
    over all of it would give.
    """
    sized = blocked(rows, group, order, size=block).withColumn("_tokens", estimate_tokens(F.length(line) + 1, chars_per_token))
    folded = sized.groupBy("_group", "_block").agg(F.sort_array(F.collect_list(F.struct("_n", "_tokens"))).alias("_rows"))
    start = F.struct(F.lit(0).alias("pack"), F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<struct<n:bigint,pack:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        fresh = (acc["sum"] > 0) & (acc["sum"] + x["_tokens"] > cap)
        pack = F.when(fresh, acc["pack"] + 1).otherwise(acc["pack"])
        return F.struct(
            pack.alias("pack"),
            F.when(fresh, x["_tokens"]).otherwise(acc["sum"] + x["_tokens"]).alias("sum"),
            F.concat(acc["out"], F.array(F.struct(x["_n"].cast("bigint").alias("n"), pack.alias("pack")))).alias("out"),
        )

    packs = folded.select("_group", "_block", F.inline(F.aggregate("_rows", start, step, lambda acc: acc["out"])))
    both = sized.join(packs.select("_group", F.col("n").alias("_n"), F.col("pack").alias("_pack")), ["_group", "_n"])
    return plain(both.withColumn("pack", F.struct(F.col("_block").alias("block"), F.col("_pack").alias("pack"))).drop("_pack", "_tokens"))
