"""Outlines of parts, chapters and sections: flattening, fallbacks, stitching, and assignment of headings to nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import heading_path_key, normalize_title
from lectern.operators.inventory import keywords, primary_bucket
from lectern.operators.ordering import numbered

_LEAF = "struct<id:string,title_en:string,title_zh:string>"
_CHAPTER = f"struct<id:string,title_en:string,title_zh:string,sections:array<{_LEAF}>>"
_PART = f"struct<id:string,title_en:string,title_zh:string,chapters:array<{_CHAPTER}>>"
OUTLINE = f"title struct<en:string,zh:string,yue_hint:string>, parts array<{_PART}>"
ASSIGNMENTS = "assignments array<struct<section_id:string,primary_node_id:string,secondary_node_id:string>>"
CONFLICTS = "array<struct<id:string,node_id:string,claim_a:struct<source:string,text:string>,claim_b:struct<source:string,text:string>,equivalent_hint:boolean,inline_tag:string>>"
TERMINATOR = "---CONFLICTS-JSON---"


def nodes(outlines: DataFrame, key: str) -> DataFrame:
    """``(key, ord, level, node_id, parent_id, title_en, title_zh)``: all nodes in pre-order; levels 1 to 3. Parts and chapters without children stay."""
    parts = outlines.select(key, F.posexplode("parts").alias("p", "part"))
    chapters = parts.select(key, "p", "part", F.posexplode("part.chapters").alias("c", "chapter"))
    leaves = chapters.select(key, "p", "c", "chapter", F.posexplode("chapter.sections").alias("s", "leaf"))
    one = parts.select(key, F.array("p", F.lit(-1), F.lit(-1)).alias("ord"), F.lit(1).alias("level"), F.col("part.id").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), "part.title_en", "part.title_zh")
    two = chapters.select(key, F.array("p", "c", F.lit(-1)).alias("ord"), F.lit(2).alias("level"), F.col("chapter.id").alias("node_id"), F.col("part.id").alias("parent_id"), "chapter.title_en", "chapter.title_zh")
    three = leaves.select(key, F.array("p", "c", "s").alias("ord"), F.lit(3).alias("level"), F.col("leaf.id").alias("node_id"), F.col("chapter.id").alias("parent_id"), "leaf.title_en", "leaf.title_zh")
    return one.unionByName(two).unionByName(three)


def leaves(flat: DataFrame, key: str) -> DataFrame:
    """The nodes that no other node names as its parent."""
    parents = flat.where(F.col("parent_id").isNotNull()).select(key, F.col("parent_id").alias("node_id")).distinct()
    return flat.join(parents, [key, "node_id"], "left_anti")


def counts(flat: DataFrame, key: str) -> DataFrame:
    of = lambda level: F.count_if(F.col("level") == level)
    return flat.groupBy(key).agg(of(1).alias("parts"), of(2).alias("chapters"), of(3).alias("sections"))


def ids(parts: Column) -> Column:
    """All ids of an outline in pre-order."""
    chapter = lambda c: F.concat(F.array(c["id"]), F.transform(F.coalesce(c["sections"], F.array().cast(f"array<{_LEAF}>")), lambda s: s["id"]))
    part = lambda p: F.concat(F.array(p["id"]), F.flatten(F.transform(F.coalesce(p["chapters"], F.array().cast(f"array<{_CHAPTER}>")), chapter)))
    return F.flatten(F.transform(parts, part))


def first_leaf_id(parts: Column) -> Column:
    """The first section, else the first chapter, else the first part, else s-unknown."""
    part = F.try_element_at(parts, F.lit(1))
    chapter = F.try_element_at(part["chapters"], F.lit(1))
    return F.coalesce(F.try_element_at(chapter["sections"], F.lit(1))["id"], chapter["id"], part["id"], F.lit("s-unknown"))


def parse_outline(text: Column) -> Column:
    """A model's JSON as an outline; null if it is invalid, has no parts, or an empty or repeated id. Unknown fields are ignored."""
    found = F.from_json(text, OUTLINE)
    all_ids = ids(found["parts"])
    valid = (F.size(found["parts"]) > 0) & F.forall(all_ids, lambda x: x.isNotNull() & (x != "")) & (F.size(F.array_distinct(all_ids)) == F.size(all_ids))
    return F.when(valid, found)


def parse_assignments(text: Column) -> Column:
    """A list of assignments, bare or wrapped; null on any error, a missing id, or an empty list. An empty secondary id is null."""
    bare = F.regexp_replace(text, r"^\s+", "")
    wrapped = F.when(bare.startswith("["), F.concat(F.lit('{"assignments":'), bare, F.lit("}"))).otherwise(bare)
    found = F.from_json(wrapped, ASSIGNMENTS)["assignments"]
    valid = (F.size(found) > 0) & F.forall(found, lambda x: x["section_id"].isNotNull() & x["primary_node_id"].isNotNull())
    clean = F.transform(found, lambda x: F.struct(x["section_id"].alias("section_id"), x["primary_node_id"].alias("primary_node_id"), F.nullif(x["secondary_node_id"], F.lit("")).alias("secondary_node_id")))
    return F.when(valid, clean)


def parse_merge_output(text: Column) -> Column:
    """``struct<markdown, conflicts>`` around the terminator line; null without it, if the list is fenced, or if it is no list of conflicts."""
    cut = F.split(text, rf"(?:^|\n){TERMINATOR}\n", 2)
    tail = F.regexp_replace(F.try_element_at(cut, F.lit(2)), r"^\s+|\s+$", "")
    found = F.from_json(tail, CONFLICTS)
    valid = (F.size(cut) == 2) & tail.startswith("[") & tail.endswith("]") & found.isNotNull() & F.forall(found, lambda x: x["id"].isNotNull() & x["node_id"].isNotNull())
    return F.when(valid, F.struct(F.element_at(cut, 1).alias("markdown"), found.alias("conflicts")))


def fallback_outline(headings: DataFrame, lexicon: dict[str, list[str]], order: str = "ord") -> DataFrame:
    """``(bucket, ord, level, node_id, parent_id, title_zh)``: a part for each bucket, a chapter for each first and a section for each second title of its paths, in the order of their first occurrence."""
    title = lambda i: F.coalesce(F.nullif(normalize_title(F.try_element_at(F.col("heading_path"), F.lit(i)), True), F.lit("")), F.lit("body"))
    rows = headings.select(primary_bucket(F.col("heading_path"), lexicon).alias("bucket"), title(1).alias("c"), title(2).alias("s"), F.col(order).alias("o"))
    pairs = rows.groupBy("bucket", "c", "s").agg(F.min("o").alias("o"))
    chapters = pairs.groupBy("bucket", "c").agg(F.min("o").alias("o")).withColumn("i", F.row_number().over(Window.partitionBy("bucket").orderBy("o", "c")))
    leaf = pairs.join(chapters.select("bucket", "c", "i"), ["bucket", "c"]).withColumn("j", F.row_number().over(Window.partitionBy("bucket", "c").orderBy("o", "s")))
    tag = lambda kind, *rest: F.concat_ws("-", F.lit(kind), "bucket", *(r.cast("string") for r in rest))
    part = chapters.select("bucket").distinct().select("bucket", F.array(F.lit(0), F.lit(0)).alias("ord"), F.lit(1).alias("level"), tag("p").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.col("bucket").alias("title_zh"))
    two = chapters.select("bucket", F.array("i", F.lit(0)).alias("ord"), F.lit(2).alias("level"), tag("c", F.col("i")).alias("node_id"), tag("p").alias("parent_id"), F.col("c").alias("title_zh"))
    three = leaf.select("bucket", F.array("i", "j").alias("ord"), F.lit(3).alias("level"), tag("s", F.col("i"), F.col("j")).alias("node_id"), tag("c", F.col("i")).alias("parent_id"), F.col("s").alias("title_zh"))
    return part.unionByName(two).unionByName(three)


def unique_ids(flat: DataFrame, order: list[str], node: str = "node_id") -> DataFrame:
    """Repeated ids get -2, -3 and so on, in order; a suffix that an original id has already is passed over.

    The n-th repetition of an id takes the n-th suffix that no original id
    holds, found by joining the taken suffixes, not by trying one after the other.
    """
    numbered = flat.withColumn("_n", F.row_number().over(Window.partitionBy(node).orderBy(*order)))
    taken = numbered.where(F.col("_n") == 1).select(F.regexp_extract(node, r"^(.*)-\d+$", 1).alias("_base"), F.regexp_extract(node, r"-(\d+)$", 1).cast("int").alias("_k"))
    holes = taken.where((F.col("_base") != "") & (F.col("_k") >= 2)).groupBy("_base").agg(F.sort_array(F.collect_set("_k")).alias("_taken"))
    joined = numbered.join(holes, F.col(node) == F.col("_base"), "left")
    suffix = F.aggregate(F.coalesce("_taken", F.array().cast("array<int>")), F.col("_n"), lambda acc, k: F.when(k <= acc, acc + 1).otherwise(acc))
    return joined.withColumn(node, F.when(F.col("_n") == 1, F.col(node)).otherwise(F.concat_ws("-", node, suffix.cast("string")))).drop("_n", "_base", "_taken")


# --- assignment --------------------------------------------------------------------------------------


def bucket_nodes(flat: DataFrame, lexicon_table: DataFrame) -> DataFrame:
    """``(bucket, node_id)`` of the buckets that match exactly one node: by a part of its id, a whole word of its English title, or a pattern in a title.

    The lexicon is a small dimension of fixed size and the outline one of a book's length, so the theta join between them is cheap.
    """
    spaced = F.translate("bucket", "_", " ")
    in_id = F.array_contains(F.split("node_id", "[-_]"), F.col("bucket")) | F.array_contains(F.split("node_id", "-"), F.translate("bucket", "_", ""))
    in_en = F.regexp_like(F.lower(F.coalesce("title_en", F.lit(""))), F.concat(F.lit(r"(?<![\p{L}\p{N}_])"), spaced, F.lit(r"(?![\p{L}\p{N}_])")))
    in_title = F.contains(F.coalesce("title_zh", F.lit("")), F.col("pattern")) | F.contains(F.lower(F.coalesce("title_en", F.lit(""))), F.lower("pattern"))
    hits = flat.select("node_id", "title_en", "title_zh").join(F.broadcast(lexicon_table), in_id | in_en | in_title).select("bucket", "node_id").distinct()
    return hits.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node_id").alias("node_id")).where("n = 1").drop("n")


def preseeded(headings: DataFrame, matched: DataFrame, lexicon: dict[str, list[str]]) -> DataFrame:
    """``(section_id, primary_node_id, secondary_node_id)`` of the headings whose buckets agree on one node; the others are for the model."""
    hits = headings.select("section_id", F.explode(keywords(F.col("heading_path"), lexicon)).alias("bucket")).join(F.broadcast(matched), "bucket")
    agreed = hits.groupBy("section_id").agg(F.min("node_id").alias("a"), F.max("node_id").alias("b")).where(F.col("a") == F.col("b"))
    return agreed.select("section_id", F.col("a").alias("primary_node_id"), F.lit(None).cast("string").alias("secondary_node_id"))


def applied_answers(batch: DataFrame, answers: DataFrame, known: DataFrame, fallback: str) -> DataFrame:
    """Each heading with the model's answer, the last of repeated ones; unknown primary nodes become ``fallback``, unknown secondary ones null."""
    last = answers.groupBy("section_id").agg(F.max_by(F.struct("primary_node_id", "secondary_node_id"), "ord").alias("answer"))
    names = known.select(F.col("node_id").alias("known")).distinct()
    return (
        batch.join(last, "section_id", "left")
        .join(names.withColumnRenamed("known", "kp"), F.col("answer.primary_node_id") == F.col("kp"), "left")
        .join(names.withColumnRenamed("known", "ks"), F.col("answer.secondary_node_id") == F.col("ks"), "left")
        .select(*batch.columns, F.coalesce("kp", F.lit(fallback)).alias("primary_node_id"), F.col("ks").alias("secondary_node_id"))
    )


def batches(rows: DataFrame, *order: str, size: int = 40) -> DataFrame:
    """``rows`` with ``batch``, the number of their batch by order."""
    return numbered(rows, *order, name="batch").withColumn("batch", F.floor(F.col("batch") / size))


def secondary_references(assignments: DataFrame) -> DataFrame:
    """``(node_id, primaries)``: for each secondary node the primary ones that point to it, in order, repeats kept."""
    rows = assignments.where(F.col("secondary_node_id").isNotNull())
    return rows.groupBy(F.col("secondary_node_id").alias("node_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "primary_node_id"))), lambda x: x["primary_node_id"]).alias("primaries"))


def heading_groups(sections: DataFrame) -> DataFrame:
    return sections.withColumn("heading_key", heading_path_key(F.col("heading_path")))
