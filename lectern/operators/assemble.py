"""Assembling documents from nodes, appendices and references, and checking them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as T

APPENDICES = (("appendix-a-sources", "Sources", "来源"), ("appendix-b-quizzes", "Quizzes", "测试"), ("appendix-c-topic", "Topic", "主题"), ("appendix-d-conflicts", "Conflicts", "分歧"), ("appendix-e-bibliography", "Bibliography", "书目"))


def ordered_text(rows: DataFrame, group: list[str], order: list[str], part: str, separator: str = "\n\n") -> DataFrame:
    """``(group, text)``: the parts of a group joined in a stated order."""
    found = F.sort_array(F.collect_list(F.struct(*order, F.col(part).alias("_part"))))
    return rows.groupBy(*group).agg(F.array_join(F.transform(found, lambda x: x["_part"]), separator).alias("text"))


def source_table(sources: DataFrame) -> DataFrame:
    """One row of Markdown: a table of stem, size and hash by stem."""
    line = F.concat(F.lit("| "), F.coalesce("stem", F.lit("")), F.lit(" | "), F.col("bytes").cast("string"), F.lit(" | "), "sha256", F.lit(" |"))
    rows = F.sort_array(F.collect_set(F.struct("stem", line.alias("line"))))
    return sources.agg(F.concat(F.lit("| stem | bytes | sha256 |\n|---|---:|---|\n"), F.array_join(F.transform(rows, lambda x: x["line"]), "\n")).alias("markdown"))


def conflict_blocks(conflicts: DataFrame) -> DataFrame:
    """A block of Markdown for each conflict, in order."""
    block = F.concat(
        F.lit("### "), "id", F.lit("\n\n- "), "claim_a.source", F.lit("："), "claim_a.text", F.lit("\n- "), "claim_b.source", F.lit("："), "claim_b.text",
        F.when(F.coalesce("inline_tag", F.lit("")) != "", F.concat(F.lit("\n\n"), "inline_tag")).otherwise(""),
    )
    return conflicts.select("id", block.alias("block"))


def quizzes(sections: DataFrame, group: tuple[str, ...] | list[str] = ("source_stem",)) -> DataFrame:
    """The quiz sections of each group, by default a source, as one text, by place in the source."""
    rows = sections.where(F.col("kind") == "quiz").dropDuplicates(["id"])
    title = F.concat(F.lit("### "), F.array_join("heading_path", " / "), F.lit("\n\n"), F.coalesce("text", F.lit("")))
    return ordered_text(rows.withColumn("block", title), list(group), ["start_line", "id"], "block")


def cited_titles(sections: DataFrame, dropped: DataFrame) -> DataFrame:
    """``(title, mentions)``: distinct 《titles》 of bibliographies and of all dropped parts."""
    texts = sections.where(F.col("kind") == "bibliography").dropDuplicates(["id"]).select("text").unionByName(dropped.dropDuplicates().select("text"))
    found = texts.select(F.explode(F.regexp_extract_all("text", F.lit("《([^》]{1,80})》"), F.lit(1))).alias("title"))
    return found.groupBy("title").agg(F.count("*").alias("mentions"))


def cross_reference(lang: str, node_id: Column, title_en: Column, title_zh: Column, title_yue: Column) -> Column:
    if lang == "en":
        return F.concat(F.lit("See also: "), title_en, F.lit(" ("), node_id, F.lit(")"))
    return F.concat(F.lit("另见：" if lang == "zh" else "另見："), title_zh if lang == "zh" else title_yue, F.lit("（"), node_id, F.lit("）"))


def document_body(flat: DataFrame, texts: DataFrame, references: DataFrame, key: str, title: str = "title_zh") -> DataFrame:
    """``(key, body)``: parts at level 2, chapters at 3, sections at 4 if they have a text, each followed by its references, in pre-order."""
    joined = flat.join(texts.select(key, "node_id", F.col("text").alias("node_text")), [key, "node_id"], "left").join(references.select(key, "node_id", F.col("text").alias("see")), [key, "node_id"], "left")
    own = {level: T.retarget_headings(F.col("node_text"), level + 1) for level in (1, 2, 3)}
    head = F.concat(F.repeat(F.lit("#"), F.col("level") + 1), F.lit(" "), F.coalesce(title, F.lit("")))
    block = F.when(F.col("node_text").isNotNull(), F.when(F.col("level") == 1, own[1]).when(F.col("level") == 2, own[2]).otherwise(own[3])).when(F.col("level") < 3, head)
    rows = joined.withColumn("block", F.concat_ws("\n\n", block, "see")).where(F.col("block") != "")
    return ordered_text(rows, [key], ["ord"], "block").withColumnRenamed("text", "body")


def document(body: Column, title: Column, contents_title: str, front: Column | None = None) -> Column:
    """Front matter, title, table of contents, body."""
    contents = T.contents_list(T.headings(body))
    return F.concat_ws("\n\n", *( [front] if front is not None else []), F.concat(F.lit("# "), title), F.concat(F.lit(f"## {contents_title}\n\n"), contents), body)


def front_matter(fields: dict[str, Column]) -> Column:
    lines = [F.concat(F.lit(f"{name}: "), T.yaml_quoted(value)) for name, value in fields.items()]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---"))


def document_faults(markdown: Column, lang: str, contents_title: str, simplified: str = "") -> Column:
    """What a finished document fails: headings, contents, and the language's own checks."""
    found = T.headings(markdown)
    tests = [
        F.when(T.count_h1(markdown) != 1, F.lit("not one title")),
        F.when(~F.coalesce((F.try_element_at(found, F.lit(1))["level"] == 1) & (F.try_element_at(found, F.lit(2))["title"] == contents_title), F.lit(False)), F.lit("no contents after the title")),
        F.when(F.exists(found, lambda h: h["title"] == ""), F.lit("empty heading")),
    ]
    if lang == "en":
        tests += [F.when(F.exists(found, lambda h: h["title"].rlike(f"[{T.HAN}]")), F.lit("ideographs in headings")), F.when(T.han_density(markdown) > 0.005, F.lit("too many ideographs"))]
    if lang == "yue":
        verdict = T.cantonese_verdict(markdown, simplified)
        return F.concat(F.filter(F.array(*tests), lambda x: x.isNotNull()), verdict["reasons"])
    return F.filter(F.array(*tests), lambda x: x.isNotNull())


def absent_sources(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Manifest rows whose file is no longer there."""
    return manifest.join(listing.select("path").distinct(), "path", "left_anti")


def aligned(left: DataFrame, right: DataFrame, key: str = "pos") -> DataFrame:
    """Two documents' parts by position; ``matched`` is false where one has no counterpart."""
    a, b = left.select(key, F.col("title").alias("title_a"), F.col("body").alias("body_a")), right.select(key, F.col("title").alias("title_b"), F.col("body").alias("body_b"))
    return a.join(b, key, "full").withColumn("matched", F.col("body_a").isNotNull() & F.col("body_b").isNotNull())


def present_appendices(texts: DataFrame, with_topic: bool = False) -> DataFrame:
    """The appendices that have a text, with their place; the one about the topic only if asked for."""
    order = texts.sparkSession.createDataFrame([(i, name) for i, (name, *_) in enumerate(APPENDICES) if with_topic or "topic" not in name], "place int, blob_id string")
    return texts.where(T.trimmed(F.coalesce("text", F.lit(""))) != "").join(F.broadcast(order), "blob_id")


def wrapped_appendix(body: Column, title: str) -> Column:
    """An appendix under its title at level 2, once."""
    bare = T.trimmed(body)
    return F.when(bare.rlike(rf"\A## {title}(?:\n|\z)"), bare).otherwise(F.concat(F.lit(f"## {title}\n\n"), bare))


def deterministic_appendices(sections: DataFrame, dropped: DataFrame, sources: DataFrame, conflicts: DataFrame) -> DataFrame:
    """``(blob_id, text)`` of the appendices that need no model: sources, quizzes, conflicts, bibliography."""
    quiz = ordered_text(quizzes(sections), [], ["source_stem"], "text")
    clash = ordered_text(conflict_blocks(conflicts), [], ["id"], "block")
    shelf = sections.where(F.col("kind") == "bibliography").dropDuplicates(["id"])
    books = ordered_text(cited_titles(sections, dropped).withColumn("line", F.concat(F.lit("- 《"), "title", F.lit("》"))), [], ["title"], "line", "\n")
    texts = ordered_text(shelf, [], ["source_stem", "start_line", "id"], "text")
    rows = (
        source_table(sources).select(F.lit(APPENDICES[0][0]).alias("blob_id"), F.col("markdown").alias("text"))
        .unionByName(quiz.select(F.lit(APPENDICES[1][0]).alias("blob_id"), "text"))
        .unionByName(clash.select(F.lit(APPENDICES[3][0]).alias("blob_id"), "text"))
        .unionByName(texts.unionByName(books).where("text <> ''").agg(F.array_join(F.collect_list("text"), "\n\n").alias("text")).select(F.lit(APPENDICES[4][0]).alias("blob_id"), "text"))
    )
    return rows.where(F.coalesce("text", F.lit("")) != "")
