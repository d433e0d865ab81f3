"""The nine stages from books to documents in three languages. Each reads published tables and publishes its own, so that a run can begin at any stage."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.functions.scripts import SIMPLIFIED_ONLY, TO_TRADITIONAL
from lectern.operators import assemble, inventory, merge, outline, sections, similarity
from lectern.plans import stages
from lectern.plans.provider import template_sections
from lectern.session import materialize
from lectern.sources import books

STAGES = ("discover", "extract", "inventory", "outline", "assign", "merge", "translate-en", "translate-yue", "assemble")
VERSION = "2"
#: A document's language, the title of its contents, and the stage that makes it.
LANGUAGES = {"zh": ("目录", None), "en": ("Contents", "translate-en"), "yue": ("目錄", "translate-yue")}


class StageFailed(RuntimeError):
    """A stage's result can't be taken; the message names the stage and the reasons."""

    def __init__(self, stage: str, reasons: list[str]):
        super().__init__(f"{stage}: " + "; ".join(reasons))
        self.stage, self.reasons = stage, reasons


def stages_between(first: str | None = None, last: str | None = None) -> tuple[str, ...]:
    a = STAGES.index(first) if first else 0
    b = STAGES.index(last) if last else len(STAGES) - 1
    if a > b:
        raise ValueError("the first stage is after the last")
    return STAGES[a : b + 1]


def read_prompts(folder: str, examples: str | None = None) -> dict[str, tuple[str, str]]:
    """``stage: (system, user)`` from a folder's files, one for each stage, with a SYSTEM and a USER section; examples of a stage are added to its system prompt."""
    out = {}
    for path in sorted(Path(folder).glob("*.md")):
        found = template_sections(path.read_text(encoding="utf-8"))
        shown = Path(examples) / path.name if examples else None
        block = f"\n\nEXAMPLES:\n{shown.read_text(encoding='utf-8').strip()}" if shown and shown.is_file() else ""
        out[path.stem] = (found.get("SYSTEM", "") + block, found.get("USER", "{payload}"))
    return out


def read_lexicon(path: str | None) -> dict[str, list[str]]:
    """The built-in lexicon with the buckets and patterns of a topic's JSON file, if there is one."""
    return inventory.merged_lexicon(json.loads(Path(path).read_text(encoding="utf-8")) if path and Path(path).is_file() else None)


@dataclass(frozen=True)
class Tables:
    sources: DataFrame
    sections: DataFrame
    dropped: DataFrame
    headings: DataFrame
    pairs: DataFrame


@dataclass
class Run:
    """One topic's tables below ``out`` and what the stages need to make them."""

    spark: SparkSession
    root: str
    topic: str
    out: str
    models: stages.Models | None = None
    lexicon: dict[str, list[str]] = field(default_factory=lambda: dict(inventory.LEXICON))
    most: int = 6000
    cap: int = 6000
    languages: tuple[str, ...] = tuple(LANGUAGES)

    def at(self, name: str) -> str:
        return f"{self.out}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.at(name))

    def publish(self, name: str, rows: DataFrame) -> None:
        books.publish(rows, self.at(name))

    @property
    def asking(self) -> stages.Models:
        if self.models is None:
            raise StageFailed("models", ["this stage asks a model, and none is given"])
        if self.models.store is None:
            self.models.store = self.at("cache")
        return self.models

    # --- deterministic stages ---

    def discover(self) -> None:
        found = books.required(books.books(self.spark, self.root, self.topic))
        self.publish("sources", found.drop("text").withColumn("version", F.lit(VERSION)))

    def extract(self) -> None:
        """Cuts the books that are new or changed; what is there of the others stays."""
        found = books.books(self.spark, self.root, self.topic)
        marks = F.struct(F.col("sha256"), F.lit(VERSION).alias("version"))
        if books.has_table(self.spark, self.at("extract")):
            old = self.read("extract")
            kept = old.join(found.select("stem", "sha256"), ["stem", "sha256"], "left_semi").where(F.col("version") == VERSION)
            changed = books.changed_only(found, old, VERSION)
        else:
            kept, changed = None, found
        cut = sections.cut_documents(changed, most=self.most).join(changed.select("stem", marks.alias("m")), "stem").select("stem", "sections", "dropped", "m.*")
        self.publish("extract", materialize(cut if kept is None else kept.select(cut.columns).unionByName(cut), "extract"))

    def inventory(self) -> None:
        cut = self.read("extract")
        rows = sections.section_rows(cut)
        self.publish("pairs", similarity.overlap_pairs(rows))
        groups = similarity.duplicate_components(rows, self.read("pairs")).where(F.col("id") != F.col("canonical")).select("id", F.col("canonical").alias("dup"))
        self.publish("sections", rows.join(groups, "id", "left").withColumn("duplicate_of", F.col("dup")).drop("dup"))
        self.publish("dropped", sections.dropped_rows(cut))
        self.publish("headings", inventory.heading_rows(self.read("sections"), self.lexicon))

    # --- stages that ask a model ---

    def numbered_headings(self) -> DataFrame:
        order = self.read("sections").select(F.col("id").alias("section_id"), F.concat_ws(":", "source_stem", F.lpad(F.col("ord").cast("string"), 9, "0")).alias("at"))
        placed = self.read("headings").join(order, "section_id")
        return outline.batches(placed, "at", "section_id", size=1).withColumnRenamed("batch", "ord").drop("at")

    def outline(self) -> None:
        self.publish("outline", stages.outlines(materialize(self.numbered_headings(), "numbered"), self.lexicon, self.asking))

    def assign(self) -> None:
        headings = materialize(self.numbered_headings(), "numbered")
        flat = self.read("outline")
        leaf = outline.leaves(flat, "bucket").agg(F.min(F.struct("bucket", "ord", "node_id")).alias("first")).select("first.node_id").first()
        self.publish("assignments", stages.assignments(headings, flat, self.lexicon, self.asking, (leaf and leaf.node_id) or "s-unknown"))

    def merge(self) -> None:
        members = merge.gathered(self.read("assignments").select("section_id", "primary_node_id", "ord"), self.read("sections").drop("ord"))
        rate, samples = 1.0, 0
        if books.has_table(self.spark, self.at("token_stats")):
            row = merge.token_rate(books.read_token_stats(self.spark, self.at("token_stats"))).first()
            rate, samples = row.chars_per_token, row.samples
        groups = materialize(stages.merged_groups(members, self.asking, self.cap, rate, samples, TO_TRADITIONAL), "groups")
        self.publish("groups", groups)
        self.publish("conflicts", stages.conflict_table(groups))
        books.reset_rows(stages.token_samples(groups), self.at("token_stats"))
        self.publish("nodes", stages.node_texts(groups, self.read("outline")))
        failed = [r.node_id for r in self.read("nodes").where("status = 'FAILED'").select("node_id").take(20)]
        if failed:
            raise StageFailed("merge", [f"failed node {n}" for n in failed])

    def originals(self) -> DataFrame:
        """``(node_id, text)`` of what is translated: the nodes and the appendices."""
        appendices = assemble.deterministic_appendices(self.read("sections"), self.read("dropped"), self.read("sources"), self.read("conflicts"))
        return self.read("nodes").where("text is not null").select("node_id", "text").unionByName(appendices.select(F.col("blob_id").alias("node_id"), "text"))

    def translate(self, stage: str) -> None:
        source = materialize(self.originals(), "originals")
        made = stages.translated(source, stage, self.asking, self.cap)
        both = source.withColumnRenamed("text", "original").join(made, "node_id", "left")
        text = T.without_han_in_headings(F.col("text")) if stage == "translate-en" else F.col("text")
        self.publish(stage, both.select("node_id", text.alias("text"), translation_faults(F.col("original"), text, stage).alias("faults")))

    # --- documents ---

    def assemble(self) -> None:
        place = {bucket: i for i, bucket in enumerate([*self.lexicon, "other"])}
        position = F.coalesce(F.try_element_at(F.create_map(*[x for k, v in place.items() for x in (F.lit(k), F.lit(v))]), F.col("bucket")), F.lit(len(place)))
        # a title that was never translated is shown by its node's name
        latin = F.coalesce(F.nullif(F.trim(F.regexp_replace("title_en", f"[{T.HAN}]", "")), F.lit("")), F.col("node_id"))
        flat = self.read("outline").withColumn("key", F.lit(self.topic)).withColumn("ord", F.concat(F.array(position), "ord")).withColumn("title_en", latin)
        see = outline.secondary_references(self.read("assignments"))
        made = None
        for lang in self.languages:
            contents, stage = LANGUAGES[lang]
            texts = (self.originals() if stage is None else self.read(stage)).select("node_id", "text").withColumn("key", F.lit(self.topic))
            title = "title_en" if lang == "en" else "title_zh"
            named = see.join(flat.select("node_id", *["title_en", "title_zh"]).dropDuplicates(["node_id"]), "node_id")
            line = assemble.cross_reference(lang, F.col("node_id"), F.col("title_en"), F.col("title_zh"), F.col("title_zh"))
            references = named.select(F.lit(self.topic).alias("key"), "node_id", F.concat(F.lit("> "), line).alias("text"))
            body = assemble.document_body(flat, texts, references, "key", title)
            number = 1 if lang == "en" else 2
            names = F.create_map(*[x for names in assemble.APPENDICES for x in (F.lit(names[0]), F.lit(names[number]))])
            shown = assemble.present_appendices(texts.withColumnRenamed("node_id", "blob_id"), with_topic=False)
            block = F.concat(F.lit("## "), F.try_element_at(names, F.col("blob_id")), F.lit("\n\n"), T.without_inner_headings(F.col("text")))
            tail = assemble.ordered_text(shown.withColumn("block", block), ["key"], ["place"], "block").withColumnRenamed("text", "tail")
            whole = F.concat_ws("\n\n", "body", "tail")
            front = assemble.front_matter({"title": F.col("key"), "language": F.lit(lang)})
            document = assemble.document(whole, T.humanized(F.col("key")), contents, front)
            rows = body.join(tail, "key", "left").select(F.lit(lang).alias("lang"), document.alias("text"))
            made = rows if made is None else made.unionByName(rows)
        documents = materialize(made, "documents")
        judged = None
        for lang in self.languages:
            row = documents.where(F.col("lang") == lang).withColumn("faults", assemble.document_faults(F.col("text"), lang, LANGUAGES[lang][0], SIMPLIFIED_ONLY))
            judged = row if judged is None else judged.unionByName(row)
        self.publish("documents", aligned_faults(judged, self.languages[0]))
        bad = [f"{r.lang}: {x}" for r in self.read("documents").where(F.size("faults") > 0).select("lang", "faults").collect() for x in r.faults]
        if bad:
            raise StageFailed("assemble", bad)

    def stage(self, name: str) -> Callable[[], None]:
        return (lambda: self.translate(name)) if name.startswith("translate-") else getattr(self, name)


def translation_faults(original: Column, text: Column, stage: str) -> Column:
    """Why a translation can't be taken: it never ended, its headings are at other levels, or its language is not the one asked for."""
    tests = [F.when(text.isNull(), F.lit("no text")), F.when(T.heading_levels(original) != T.heading_levels(text), F.lit("other headings"))]
    if stage == "translate-en":
        return F.filter(F.array(*tests, F.when(T.han_density(text) > 0.005, F.lit("too many ideographs"))), lambda x: x.isNotNull())
    verdict = T.cantonese_verdict(F.coalesce(text, F.lit("")), SIMPLIFIED_ONLY)
    return F.concat(F.filter(F.array(*tests), lambda x: x.isNotNull()), verdict["reasons"])


def aligned_faults(documents: DataFrame, first: str) -> DataFrame:
    """The documents with one more fault where the levels of their headings are not those of the first language's."""
    levels = documents.where(F.col("lang") == first).select(T.heading_levels(F.col("text"), 4).alias("_levels"))
    joined = documents.join(F.broadcast(levels.limit(1)), F.lit(True), "left")
    differs = F.coalesce(T.heading_levels(F.col("text"), 4) != F.col("_levels"), F.lit(False))
    return joined.select("lang", "text", F.concat("faults", F.when(differs, F.array(F.lit("headings at other levels"))).otherwise(F.array().cast("array<string>"))).alias("faults"))


def run(job: Run, first: str | None = None, last: str | None = None) -> tuple[str, ...]:
    """Runs the stages of a range in order, and names them. Languages that are not asked for are passed over."""
    wanted = [s for s in stages_between(first, last) if not s.startswith("translate-") or s in {LANGUAGES[lang][1] for lang in job.languages}]
    for name in wanted:
        job.stage(name)()
    return tuple(wanted)


def build(spark: SparkSession, root: str, topic: str, out: str, lexicon: dict[str, list[str]] | None = None, most: int = 6000) -> Tables:
    """Runs discovery, extraction and inventory, and publishes their tables under ``out``."""
    job = Run(spark, root, topic, out, lexicon=lexicon or dict(inventory.LEXICON), most=most)
    run(job, None, "inventory")
    return Tables(*map(job.read, ("sources", "sections", "dropped", "headings", "pairs")))
