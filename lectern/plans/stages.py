"""Stages that ask a model: outline, assign, merge, translate, summarize, script.

Every stage makes a table of requests, joins it with the cache, calls the
provider for the misses, checks the answers with native expressions, and takes
a deterministic fallback where an answer fails. Retries are further rounds
over the rows that failed, so nothing is called again for rows that passed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions import budget
from lectern.functions import text as T
from lectern.operators import inventory, merge, outline
from lectern.plans.provider import Provider, cache_key, completed, filled
from lectern.session import materialize
from lectern.sources.books import has_table

_CACHE = "cache_key string, response_text string, finish_reason string, input_tokens int, output_tokens int"
SUMMARY_CHARS, SUMMARY_CHUNK, APPENDIX_CHARS = 800, 20_000, 2500


@dataclass
class Models:
    """A provider, its prompts by stage, and the cache that grows with each round."""

    provider: Provider
    model: str = "model"
    prompts: dict[str, tuple[str, str]] = field(default_factory=dict)
    cache: DataFrame | None = None
    force: bool = False
    #: Where the cache is kept between runs, as Parquet to which each round's answers are added.
    store: str | None = None

    def known(self, spark: SparkSession) -> DataFrame:
        """The answers there are, of this run or kept by earlier ones."""
        if self.cache is None and self.store is not None and has_table(spark, self.store):
            self.cache = spark.read.parquet(self.store)
        return self.cache if self.cache is not None else spark.createDataFrame([], _CACHE)

    def asked(self, rows: DataFrame, stage: str, values: dict[str, Column], max_tokens: Column | None = None, tag: str = "") -> DataFrame:
        """``rows`` with ``response_text`` and ``finish_reason``; ``values`` fill the stage's template."""
        temperature, limit, json_mode, _ = budget.STAGES[stage]
        system, template = self.prompts.get(stage, ("", "{payload}"))
        user = filled(template, **values)
        limit = max_tokens if max_tokens is not None else F.lit(limit)
        params = F.struct(F.lit(json_mode).alias("json_mode"), limit.cast("int").alias("max_tokens"), F.lit(temperature).alias("temperature"))
        key = cache_key(F.lit(stage), F.lit(self.model), F.sha2(F.lit(system + "\x00" + template + tag), 256), params, F.array(F.sha2(user, 256)))
        requests = rows.withColumns({"cache_key": key, "system": F.lit(system), "user_text": user, "temperature": F.lit(temperature), "max_tokens": limit.cast("int"), "json_mode": F.lit(json_mode)})
        known = self.known(rows.sparkSession)
        answers, new = completed(materialize(requests, "requests"), known, self.provider, self.force)
        if self.store is not None:
            # what was called before is not kept twice; an append shows its files when it commits
            new.select("cache_key", "response_text", "finish_reason", "input_tokens", "output_tokens", "created_at").write.mode("append").parquet(self.store)
        self.cache = known.select("cache_key", "response_text", "finish_reason", "input_tokens", "output_tokens").unionByName(new.drop("created_at"))
        return answers.drop("cache_key", "system", "user_text", "temperature", "max_tokens", "json_mode", "input_tokens")


def complete_text(text: Column, reason: Column) -> Column:
    """An answer that ended by itself and says something, else null."""
    return F.when((reason != "length") & (T.trimmed(text) != ""), text)


def outlines(headings: DataFrame, lexicon: dict[str, list[str]], models: Models, cap: int = inventory.HEADING_TOKENS) -> DataFrame:
    """``(bucket, ord, level, node_id, parent_id, title_en, title_zh)``: a model's outline of each bucket's packs, or the fallback for buckets in which an answer failed. Ids are made unique."""
    lined = headings.withColumn("bucket", inventory.primary_bucket(F.col("heading_path"), lexicon)).withColumn("line", F.concat_ws("|", "section_id", F.array_join("heading_path", ">")))
    packed = inventory.packed_headings(lined, "bucket", "ord", "line", cap)
    payload = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "line"))), lambda x: x["line"]), "\n")
    answers = models.asked(packed.groupBy("bucket", "pack").agg(payload.alias("payload")), "outline", {"payload": F.col("payload"), "bucket": F.col("bucket")})
    parsed = materialize(answers.withColumn("o", outline.parse_outline(T.without_fences(complete_text(F.col("response_text"), F.col("finish_reason"))))), "outlines")
    failed = parsed.where(F.col("o").isNull()).select("bucket").distinct()
    good = parsed.join(failed, "bucket", "left_anti").select("bucket", F.col("pack").alias("k"), "o.parts")
    made = outline.nodes(good.withColumn("key", F.struct("bucket", "k")), "key").select("key.bucket", F.concat(F.array(F.col("key.k.block").cast("int"), F.col("key.k.pack")), "ord").alias("ord"), "level", "node_id", "parent_id", "title_en", "title_zh")
    plain = outline.fallback_outline(headings, lexicon).join(failed, "bucket", "left_semi").select("bucket", "ord", "level", "node_id", "parent_id", F.initcap(F.translate("title_zh", "_", " ")).alias("title_en"), "title_zh")
    return outline.unique_ids(made.unionByName(plain), ["bucket", "ord"])


def assignments(headings: DataFrame, flat: DataFrame, lexicon: dict[str, list[str]], models: Models, fallback: str, size: int = 40) -> DataFrame:
    """``(section_id, ord, primary_node_id, secondary_node_id)`` of all headings: by rule where the titles agree on a node, else by the model in batches, halved once where an answer fails, else the fallback node."""
    matched = outline.bucket_nodes(flat, inventory.lexicon_rows(headings.sparkSession, lexicon))
    seeded = materialize(outline.preseeded(headings, matched, lexicon), "seeded")
    rest = headings.join(seeded, "section_id", "left_anti").select("section_id", "ord", "heading_path")
    known = materialize(flat.select("node_id").distinct(), "nodes")
    batch = outline.batches(rest, "ord", size=size).withColumn("line", F.concat_ws("|", "section_id", F.array_join("heading_path", ">")))

    def ask(rows: DataFrame, tag: str) -> DataFrame:
        lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "line"))), lambda x: x["line"]), "\n")
        asked = models.asked(rows.groupBy("batch").agg(lines.alias("payload")), "assign", {"payload": F.col("payload")}, tag=tag)
        return materialize(asked.select("batch", outline.parse_assignments(T.without_fences(complete_text(F.col("response_text"), F.col("finish_reason")))).alias("found")), "answers")

    first = ask(batch, "")
    failed = batch.join(first.where(F.col("found").isNull()).select("batch"), "batch", "left_semi")
    second = ask(failed.withColumn("batch", F.col("batch") * 2 + F.when(F.col("ord") % 2 == 0, 0).otherwise(1)), "half")
    rows = first.unionByName(second).select(F.posexplode("found").alias("at", "a")).select("a.*", F.col("at").alias("ord"))
    applied = outline.applied_answers(rest.select("section_id", "ord"), rows, known, fallback)
    by_rule = headings.select("section_id", "ord").join(seeded, "section_id")
    return by_rule.unionByName(applied)


def payloads(members: DataFrame, group: list[str]) -> DataFrame:
    """``(group, payload, grafted, payload_chars)`` under the group's ``cap``; a group is what one heading of one node has, so that its texts fit a task as they must fit a call."""
    columns = ["id", "source_stem", "text", "char_count"]
    out = schema_of(members, group) + ", payload string, grafted boolean, payload_chars bigint"

    def packed(table: pa.Table) -> pa.Table:
        text, cut, size = merge.payload(table.select(columns).to_pylist(), table.column("cap")[0].as_py())
        keys = {g: [table.column(g)[0].as_py()] for g in group}
        return pa.table({**keys, "payload": [text], "grafted": [cut], "payload_chars": [size]})

    return members.select(*group, *columns, "cap").groupBy(*group).applyInArrow(packed, out)


def schema_of(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema.fields)


GROUP = ["node_id", "heading_key"]
#: Rounds in which a group that is too much for one call is folded, two members at a time.
DEPTH = 3
_NONE = f"CAST(array() AS {outline.CONFLICTS})"


@dataclass
class Merging:
    """Merges groups of members by calls of a model; see merged_groups."""

    models: Models
    rate: float = 1.0
    samples: int = 0
    convert: tuple[str, str] = ("", "")

    def sized(self, rows: DataFrame) -> DataFrame:
        """Groups with what a call would be sent, what it must keep, and whether that is over the budget."""
        facts = merge.required_tokens(rows, GROUP)
        metrics = merge.union_metrics(rows, merge.group_pairs(rows, GROUP), GROUP)
        plain = merge.concatenated(rows, GROUP).withColumnRenamed("markdown", "plain")
        counts = rows.groupBy(*GROUP).agg(F.count("*").alias("n"), F.max("cap").alias("cap"), F.max("depth").alias("depth"))
        joined = payloads(rows, GROUP).join(metrics, GROUP).join(facts, GROUP, "left").join(plain, GROUP).join(counts, GROUP)
        expected = budget.expected_output(F.col("union_chars"), F.col("payload_chars"), F.col("grafted"))
        full = joined.withColumn("required", F.coalesce("required", F.array().cast("array<string>"))).withColumn("expected", expected)
        over = (F.col("payload_chars") > F.col("cap")) | budget.over_budget(F.lit(0), F.col("expected"), 0, self.rate)
        return materialize(full.withColumn("over", over), "sized")

    def judged(self, answers: DataFrame) -> DataFrame:
        """Answers cut into text and conflicts, with their faults; ``cut`` where the model ran out of tokens."""
        parsed = answers.withColumn("parsed", outline.parse_merge_output(complete_text(F.col("response_text"), F.col("finish_reason"))))
        with_text = parsed.select("*", F.col("parsed.markdown").alias("merged"), F.coalesce("parsed.conflicts", F.expr(_NONE)).alias("conflicts"), F.coalesce(F.col("finish_reason") == "length", F.lit(False)).alias("cut"))
        faults = F.when(F.col("merged").isNull(), F.array(F.lit("no valid answer"))).otherwise(merge.merge_faults(F.coalesce("merged", F.lit("")), F.col("required"), F.col("size_floor"), self.convert))
        return materialize(with_text.withColumn("faults", faults).drop("response_text", "finish_reason", "parsed"), "judged")

    def called(self, sized: DataFrame) -> DataFrame:
        """Groups merged by one call each, or by a second one that names what the first lacked."""
        limit = budget.max_tokens(F.col("expected"), self.rate, F.lit(self.samples))
        first = self.judged(self.models.asked(sized, "merge", {"payload": F.col("payload"), "missing": F.lit("")}, limit))
        again = first.where((F.size("faults") > 0) & ~F.col("cut")).withColumn("asked_for", F.concat(F.lit("\nMISSING: "), F.array_join("faults", "; "))).drop("merged", "faults", "conflicts", "cut", "output_tokens")
        second = self.judged(self.models.asked(again, "merge", {"payload": F.concat("payload", "asked_for"), "missing": F.col("asked_for")}, limit, tag="retry")).drop("asked_for")
        return first.where((F.size("faults") == 0) | F.col("cut")).unionByName(second)

    def settled(self, done: DataFrame) -> DataFrame:
        """The result of a call: its text, or the members joined if it has faults; a digest's phrases fail the group."""
        digest, good = F.exists("faults", lambda x: x == "forbidden phrase"), F.size("faults") == 0
        text = F.when(good, F.col("merged")).when(~digest, F.col("plain"))
        status = F.when(good, "merged").when(digest, "failed").otherwise("concatenated")
        return done.select(*GROUP, text.alias("markdown"), status.alias("status"), "faults", F.when(good, F.col("conflicts")).otherwise(F.expr(_NONE)).alias("conflicts"), F.when(good, F.col("output_tokens")).alias("output_tokens"))

    @staticmethod
    def joined(over: DataFrame) -> DataFrame:
        return over.select(*GROUP, F.col("plain").alias("markdown"), F.lit("concatenated").alias("status"), F.array(F.lit("over budget")).alias("faults"), F.expr(_NONE).alias("conflicts"), F.lit(None).cast("int").alias("output_tokens"))

    def round(self, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """``(results, waiting, conflicts)``: groups that are done, members that go on to the next round, and the conflicts met in folding."""
        sized = self.sized(rows)
        can_fold = (F.col("n") >= 3) & (F.col("depth") < DEPTH)
        done = self.called(sized.where(~F.col("over")))
        results = self.settled(done.where(~(F.col("cut") & can_fold))).unionByName(self.joined(sized.where(F.col("over") & ~can_fold)))
        # an answer that ran out of tokens: the same members with half of the input
        halved = rows.join(done.where(F.col("cut") & can_fold).select(*GROUP), GROUP, "left_semi").withColumn("cap", F.greatest(F.floor(F.col("cap") / 2).cast("int"), F.lit(1))).withColumn("depth", F.col("depth") + 1)
        # too much for a call: the two longest members become one
        place = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc(F.coalesce("char_count", F.lit(0))), "id"))
        folding = rows.join(sized.where(F.col("over") & can_fold).select(*GROUP), GROUP, "left_semi").withColumn("place", place)
        pair = materialize(folding.where("place <= 2").drop("place"), "pairs")
        pair_sized = self.sized(pair)
        two = materialize(self.settled(self.called(pair_sized.where("not over"))).unionByName(self.joined(pair_sized.where("over"))), "folded")
        failed = two.where("status = 'failed'")
        made = pair.join(two.where("status <> 'failed'").select(*GROUP, "markdown"), GROUP).groupBy(*GROUP, "markdown").agg(F.min("id").alias("id"), F.min("source_stem").alias("source_stem"), F.first("heading_path").alias("heading_path"), F.max("cap").alias("cap"), F.max("depth").alias("depth"))
        synthetic = made.select(*GROUP, F.concat(F.lit("folded:"), "id").alias("id"), "source_stem", "heading_path", F.col("markdown").alias("text"), F.length("markdown").alias("char_count"), F.sha2("markdown", 256).alias("content_hash"), F.lit(None).cast("string").alias("duplicate_of"), "cap", (F.col("depth") + 1).alias("depth"))
        left = folding.where("place > 2").join(failed.select(*GROUP), GROUP, "left_anti").withColumn("depth", F.col("depth") + 1).select(*synthetic.columns)
        waiting = halved.select(*synthetic.columns).unionByName(synthetic).unionByName(left)
        return results.unionByName(failed), materialize(waiting, "waiting"), two.select(*GROUP, F.explode("conflicts").alias("conflict"))


def merged_groups(members: DataFrame, models: Models, cap: int = 6000, rate: float = 1.0, samples: int = 0, convert: tuple[str, str] = ("", "")) -> DataFrame:
    """``(node_id, heading_key, markdown, status, faults, conflicts, output_tokens)`` of each group of members under one heading.

    One member passes as it is. Several are merged by the model; an answer
    without all facts is asked for again once with the missing ones named. A
    group of three or more that exceeds the budget has its two longest members
    merged first and goes on with the result, up to three times; one whose
    answer runs out of tokens goes on with half of the input. What still fails,
    or exceeds the budget, becomes the concatenation of the members. A digest's
    phrases fail the group. Conflicts met in folding come first.
    """
    rows = materialize(merge.unique_members(outline.heading_groups(members), GROUP).select(*GROUP, "id", "source_stem", "heading_path", "text", "char_count", "content_hash", "duplicate_of", F.lit(cap).alias("cap"), F.lit(0).alias("depth")), "members")
    counts = rows.groupBy(*GROUP).agg(F.count("*").alias("n"))
    single = rows.join(counts.where("n = 1"), GROUP).select(*GROUP, F.col("text").alias("markdown"), F.lit("single").alias("status"), F.array().cast("array<string>").alias("faults"), F.expr(_NONE).alias("conflicts"), F.lit(None).cast("int").alias("output_tokens"))
    merging, results, met = Merging(models, rate, samples, convert), single, None
    waiting = rows.join(counts.where("n > 1").drop("n"), GROUP)
    for _ in range(DEPTH + 1):
        if waiting.isEmpty():
            break
        done, waiting, conflicts = merging.round(waiting)
        results = results.unionByName(done)
        met = conflicts if met is None else met.unionByName(conflicts)
    if met is None:
        return results
    before = met.groupBy(*GROUP).agg(F.collect_list("conflict").alias("before"))
    return results.join(before, GROUP, "left").withColumn("conflicts", F.concat(F.coalesce("before", F.expr(_NONE)), "conflicts")).drop("before")


def conflict_table(groups: DataFrame) -> DataFrame:
    """The conflicts of all groups, each once."""
    return groups.select(F.explode("conflicts").alias("c")).select("c.*").dropDuplicates(["id", "node_id"])


def token_samples(groups: DataFrame) -> DataFrame:
    """``(chars_out, output_tokens)`` of the groups that were merged, by which later budgets are set."""
    return groups.where("status = 'merged' and output_tokens > 0").select(F.length("markdown").alias("chars_out"), "output_tokens")


def node_texts(groups: DataFrame, titles: DataFrame) -> DataFrame:
    """``(node_id, status, text, reasons)``: a node's groups under its title; one failed group fails the node."""
    many = groups.groupBy("node_id").agg(F.count("*").alias("n"))
    head = F.when(F.col("n") > 1, F.concat(F.lit("#### "), F.coalesce(F.try_element_at(F.split("heading_key", ">"), F.lit(-1)), F.lit("")), F.lit("\n\n"))).otherwise("")
    rows = groups.join(many, "node_id").withColumn("block", F.concat(head, F.coalesce("markdown", F.lit(""))))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("heading_key", "block"))), lambda x: x["block"])
    nodes = rows.groupBy("node_id").agg(F.array_join(parts, "\n\n").alias("body"), F.bool_or(F.col("status") == "failed").alias("bad"), F.flatten(F.collect_list("faults")).alias("reasons"))
    named = nodes.join(titles.select("node_id", "title_zh").dropDuplicates(["node_id"]), "node_id", "left")
    return named.select("node_id", F.when(F.col("bad"), "FAILED").otherwise("OK").alias("status"), F.when(~F.col("bad"), F.concat(F.lit("### "), F.coalesce("title_zh", "node_id"), F.lit("\n\n"), "body")).alias("text"), "reasons")


def translated(texts: DataFrame, stage: str, models: Models, cap: int = 6000, rounds: int = 4) -> DataFrame:
    """``(node_id, text)`` translated in chunks; chunks whose answer is cut off are halved and asked for again. A node of which a chunk never ends is null."""
    factor = 1.6 if stage == "translate-en" else 1.1
    waiting = texts.select("node_id", F.posexplode(T.translation_chunks(F.col("text"), cap)).alias("at", "chunk")).withColumn("at", F.array("at"))
    finished: DataFrame | None = None
    for number in range(rounds):
        answers = models.asked(waiting, stage, {"payload": F.col("chunk")}, budget.max_tokens(F.length("chunk") * factor, 1.0, F.lit(5)), tag=str(number))
        answers = materialize(answers.withColumn("out", complete_text(T.without_fences(F.col("response_text")), F.col("finish_reason"))).select("node_id", "at", "chunk", "out"), "translated")
        last = number == rounds - 1
        part = answers if last else answers.where(F.col("out").isNotNull())
        finished = part if finished is None else finished.unionByName(part)
        cut = answers.where(F.col("out").isNull())
        if last or cut.isEmpty():
            break
        half = F.ceil(F.length("chunk") / 2).cast("int")
        halves = F.transform(F.array(F.lit(0), F.lit(1)), lambda i: F.struct(F.concat("at", F.array(i)).alias("at"), F.substring(F.col("chunk"), i * half + 1, half).alias("chunk")))
        waiting = cut.select("node_id", F.inline(halves)).where("chunk <> ''")
    rows = F.sort_array(F.collect_list(F.struct("at", "out")))
    return finished.groupBy("node_id").agg(F.when(F.bool_and(F.col("out").isNotNull()), F.array_join(F.transform(rows, lambda x: x["out"]), "\n\n")).alias("text"))


def summarized(bodies: DataFrame, models: Models, ratio: float = 0.05, short: int = SUMMARY_CHARS) -> DataFrame:
    """``(key, text)``: short bodies as they are, others summarized in chunks and joined; a failed chunk keeps its text."""
    brief = bodies.where(F.length("body") < short).select("key", F.col("body").alias("text"))
    chunks = bodies.where(F.length("body") >= short).select("key", F.posexplode(T.packed_paragraphs(T.paragraphs(F.col("body")), SUMMARY_CHUNK)).alias("at", "chunk"))
    answers = models.asked(chunks, "summarize", {"payload": F.col("chunk"), "ratio": F.lit(str(ratio))}, budget.summary_tokens(F.length("chunk"), ratio))
    kept = answers.withColumn("out", F.coalesce(complete_text(F.col("response_text"), F.col("finish_reason")), "chunk"))
    rows = F.sort_array(F.collect_list(F.struct("at", "out")))
    return brief.unionByName(kept.groupBy("key").agg(F.array_join(F.transform(rows, lambda x: x["out"]), "\n\n").alias("text")))


def tightened(documents: DataFrame, models: Models, ratio: float = 0.35) -> DataFrame:
    """``(key, text)``: a second pass over the bodies below headings of level 3, all headings kept."""
    parts = documents.select("key", F.posexplode(T.sections_at(F.col("text"), 3)).alias("at", "s")).select(F.struct("key", "at").alias("key"), "s.title", F.coalesce("s.body", F.lit("")).alias("body"))
    short = summarized(parts.select("key", "body"), models, ratio)
    joined = parts.select("key", "title").join(short, "key")
    block = F.concat(F.when(F.col("title").isNotNull(), F.concat(F.lit("### "), "title", F.lit("\n\n"))).otherwise(""), "text")
    rows = F.sort_array(F.collect_list(F.struct(F.col("key.at").alias("at"), block.alias("block"))))
    return joined.groupBy(F.col("key.key").alias("key")).agg(F.array_join(F.transform(rows, lambda x: x["block"]), "\n\n").alias("text"))


def scripted(documents: DataFrame, models: Models) -> DataFrame:
    """``(key, text)``: documents turned into a spoken script part by part; null if a part's answer fails."""
    chunks = documents.select("key", F.posexplode(T.script_chunks(F.col("text"))).alias("at", "chunk"))
    answers = models.asked(chunks, "script", {"payload": F.col("chunk")}, budget.script_tokens(F.length("chunk")))
    kept = answers.withColumn("out", T.without_fences(complete_text(F.col("response_text"), F.col("finish_reason"))))
    rows = F.sort_array(F.collect_list(F.struct("at", "out")))
    return kept.groupBy("key").agg(F.when(F.bool_and(F.col("out").isNotNull()), F.array_join(F.transform(rows, lambda x: x["out"]), "\n\n")).alias("text"))
