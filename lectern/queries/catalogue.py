"""Queries of the core operators over whole tables, each with SQL that gives the same rows where SQL can."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions import budget, coverage, predicates
from lectern.functions import text as T
from lectern.operators import assemble, inventory, merge, outline, sections, similarity
from lectern.operators.components import connected_components
from lectern.operators.ordering import BLOCK, blocked, in_block, over_blocks
from lectern.plans.provider import FakeProvider, compacted, completed
from lectern.session import balanced, materialize, table
from lectern.sources.books import line_count
from lectern.streaming.ingest import sessions, windowed_counts

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

#: The same classes in the SQL engine's regular expressions.
_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_HAN = r"[\x{4e00}-\x{9fff}]"
_WORDS = r"[^\p{L}\p{N}_]+"
#: Sections by id, whatever the number of deliveries: the first one.
_SECTIONS = "(SELECT * FROM sections QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1)"


def _nfkc(x: str) -> str:
    """NFKC in SQL, for letters and digits: characters that become one other by translation, those that become several one by one, then composition."""
    single, several = {}, []
    for code in (*range(0xA0, 0x3400), *range(0xF900, 0x10000)):
        new = unicodedata.normalize("NFKC", chr(code))
        if new != chr(code) and any(c.isalnum() for c in new):
            if len(new) == 1:
                single[chr(code)] = new
            elif 0x2100 <= code <= 0x218B or 0xBC <= code <= 0xBE or 0xFB00 <= code <= 0xFB06 or code in (0x338E, 0x338F, 0x339D, 0x33A1):
                several.append((chr(code), new))
    out = f"translate({x}, '{''.join(single)}', '{''.join(single.values())}')"
    for c, new in several:
        out = f"replace({out}, '{c}', '{new}')"
    return f"nfc_normalize({out})"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def added(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return added


def of_sections(spark: SparkSession, base: str, **columns: Column | str) -> DataFrame:
    """What is computed of each section, each id once: computed where the section is read, so that results are shuffled and not texts."""
    made = [F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for n, c in columns.items()]
    return table(spark, base, "sections").select(*made).distinct()


def first_deliveries(sections: DataFrame, *columns: str) -> DataFrame:
    """Each id once, as first delivered, with these columns, for what depends on ord; the aggregate combines map-side and carries no more than they need."""
    rest = [c for c in dict.fromkeys(columns) if c not in ("id", "ord")]
    best = sections.groupBy("id").agg(F.min_by(F.struct("ord", *rest), "ord").alias("s"))
    return best.select("id", "s.*")


def originals(sections: DataFrame) -> DataFrame:
    """Sections that are no duplicates: without a link, or with one to themselves or to an id that does not exist. Only linked rows are shuffled."""
    ids = sections.select(F.col("id").alias("_present")).where(F.col("_present").isNotNull()).distinct()
    linked = sections.where(F.col("duplicate_of") != F.col("id")).join(ids, F.col("duplicate_of") == F.col("_present"), "left_anti")
    return sections.where(F.col("duplicate_of").isNull() | (F.col("duplicate_of") == F.col("id"))).unionByName(linked)


def _bucket(rest: str = "heading_path") -> str:
    cases = " ".join("WHEN " + " OR ".join(f"contains(j, '{p}')" for p in patterns) + f" THEN '{bucket}'" for bucket, patterns in inventory.LEXICON.items())
    return f"(CASE {cases} ELSE 'other' END)".replace("contains(j,", f"contains(array_to_string({rest}, ''),")


def _path() -> Column:
    return F.coalesce("heading_path", F.array().cast("array<string>"))


# --- scans, counts and hashes ---------------------------------------------------------------------


@query("""SELECT source, count(*) AS documents, sum(coalesce(length(text), 0))::BIGINT AS chars, sum(coalesce(strlen(text), 0))::BIGINT AS bytes,
  sum(CASE WHEN text IS NULL OR text = '' THEN 0 ELSE length(text) - length(replace(text, chr(10), '')) + CASE WHEN text LIKE '%' || chr(10) THEN 0 ELSE 1 END END)::BIGINT AS lines
  FROM documents GROUP BY source""")
def source_manifest(spark: SparkSession, base: str) -> DataFrame:
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return table(spark, base, "documents").groupBy("source").agg(
        F.count("*").alias("documents"), F.sum(zero(F.length("text"))).alias("chars"), F.sum(zero(F.octet_length("text"))).alias("bytes"), F.sum(zero(line_count(F.col("text")))).alias("lines")
    )


@query(f"SELECT doc_id, sha256(regexp_replace({_nfkc('text')}, '{_WORDS}', '', 'g')) AS content_hash FROM documents")
def content_hashes(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "documents").select("doc_id", T.content_hash(F.col("text")).alias("content_hash"))


@query(f"""SELECT h AS content_hash, count(*) AS members, arg_min(doc_id, struct_pack(a := -length(text), b := doc_id)) AS canonical
  FROM (SELECT *, sha256(regexp_replace({_nfkc('text')}, '{_WORDS}', '', 'g')) AS h FROM documents WHERE text IS NOT NULL) GROUP BY h HAVING count(*) > 1""")
def exact_dup_groups(spark: SparkSession, base: str) -> DataFrame:
    """Groups of equal content with their longest document."""
    rows = table(spark, base, "documents").where(F.col("text").isNotNull()).select("doc_id", F.length("text").alias("size"), T.content_hash(F.col("text")).alias("content_hash"))
    return rows.groupBy("content_hash").agg(F.count("*").alias("members"), F.min(F.struct(-F.col("size"), "doc_id")).getField("doc_id").alias("canonical")).where("members > 1")


@query("SELECT reason, count(*) AS parts, sum(length(text))::BIGINT AS chars FROM (SELECT DISTINCT * FROM dropped) GROUP BY reason")
def dropped_reasons(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "dropped").distinct().groupBy("reason").agg(F.count("*").alias("parts"), F.sum(F.length("text")).alias("chars"))


@query("SELECT DISTINCT source_stem FROM sections WHERE source_stem IS NOT NULL AND source_stem NOT IN (SELECT stem FROM sources WHERE stem IS NOT NULL)")
def absent_sources(spark: SparkSession, base: str) -> DataFrame:
    stems = table(spark, base, "sections").select(F.col("source_stem").alias("path")).where(F.col("path").isNotNull()).distinct()
    return assemble.absent_sources(stems, table(spark, base, "sources").select(F.col("stem").alias("path"))).withColumnRenamed("path", "source_stem")


@query("""SELECT string_agg(line, chr(10) ORDER BY stem, line) AS markdown FROM
  (SELECT DISTINCT stem, '| ' || coalesce(stem, '') || ' | ' || bytes::VARCHAR || ' | ' || sha256 || ' |' AS line FROM sources)""")
def source_table(spark: SparkSession, base: str) -> DataFrame:
    whole = assemble.source_table(table(spark, base, "sources"))
    return whole.select(F.regexp_replace("markdown", r"\A[^\n]*\n[^\n]*\n", "").alias("markdown"))


# --- projections and predicates -------------------------------------------------------------------


@query(f"""SELECT id AS section_id, CASE WHEN length(f) > 40 THEN substr(f, 1, 40) || '……' ELSE f END AS excerpt
  FROM (SELECT id, regexp_replace(text, '{_WS}+', '', 'g') AS f FROM {_SECTIONS})""")
def excerpts(spark: SparkSession, base: str) -> DataFrame:
    return of_sections(spark, base, section_id="id", excerpt=T.excerpt(F.col("text")))


@query(f"SELECT id AS section_id, {_bucket()} AS bucket FROM {_SECTIONS}")
def primary_buckets(spark: SparkSession, base: str) -> DataFrame:
    return of_sections(spark, base, section_id="id", bucket=inventory.primary_bucket(_path(), inventory.LEXICON))


@query("SELECT id AS section_id, array_to_string(list_filter([" + ", ".join("CASE WHEN " + " OR ".join(f"contains(array_to_string(heading_path, ''), '{p}')" for p in ps) + f" THEN '{b}' END" for b, ps in inventory.LEXICON.items()) + f"], lambda x: x IS NOT NULL), ',') AS keywords FROM {_SECTIONS}")
def keyword_buckets(spark: SparkSession, base: str) -> DataFrame:
    return of_sections(spark, base, section_id="id", keywords=F.array_join(inventory.keywords(_path(), inventory.LEXICON), ","))


@query(f"SELECT bucket, count(*) AS rows FROM (SELECT {_bucket()} AS bucket FROM {_SECTIONS}) GROUP BY bucket")
def bucket_counts(spark: SparkSession, base: str) -> DataFrame:
    return inventory.bucket_counts(of_sections(spark, base, id="id", heading_path=_path()), inventory.LEXICON).select("bucket", "rows")


@query(f"""SELECT id, regexp_matches(t, '{predicates.CHAPTER}') AS chapter, regexp_matches(t, '{predicates.SECTION}') AS section, p AS numbered,
  coalesce(regexp_matches(text, '(?:^|{_WS})A[.．、]') AND regexp_matches(text, '(?:^|{_WS})B[.．、]') AND regexp_matches(text, '(?:^|{_WS})C[.．、]'), false) AS choices
  FROM (SELECT id, text, t, CASE WHEN n = '' THEN NULL ELSE len(regexp_extract_all(n, '[.．-]')) + 1 END AS p FROM (SELECT id, text, t, regexp_extract(t, '^(\\p{{Nd}}+(?:[.．-]\\p{{Nd}}+)+)(?:[^\\p{{L}}\\p{{N}}_]|$)', 1) AS n FROM
  (SELECT id, text, regexp_replace(regexp_replace(regexp_replace(heading_path[-1], '[*_`]+', '', 'g'), '{_WS}+', ' ', 'g'), '^ | $', '', 'g') AS t FROM {_SECTIONS} WHERE len(heading_path) > 0)))""")
def heading_flags(spark: SparkSession, base: str) -> DataFrame:
    title = F.try_element_at("heading_path", F.lit(-1))
    rows = of_sections(
        spark, base, id="id", chapter=predicates.is_chapter(title), section=predicates.is_section(title), numbered=predicates.numbered_depth(title).cast("bigint"), choices=F.coalesce(predicates.has_choices(F.col("text")), F.lit(False))
    )
    return rows.where(F.col("chapter").isNotNull())


@query()
def section_kinds(spark: SparkSession, base: str) -> DataFrame:
    """The kind that a section's own title and text give, and the structural level of its title."""
    title = F.coalesce(F.try_element_at("heading_path", F.lit(-1)), F.lit(""))
    return of_sections(spark, base, id="id", kind=predicates.section_kind(title, F.coalesce("text", F.lit(""))), level=predicates.structural_level(title, F.coalesce("level", F.lit(1))))


# --- text statistics ------------------------------------------------------------------------------


@query(f"""SELECT doc_id, length(text) - length(regexp_replace(text, '{_HAN}', '', 'g')) AS han, length(text) - length(regexp_replace(text, '[的是不]', '', 'g')) AS mandarin,
  length(text) - length(regexp_replace(text, '[嘅係唔]', '', 'g')) AS cantonese, len(regexp_extract_all(text, '{_WS.replace('[', '[^', 1)}+'))::BIGINT AS words
  FROM documents WHERE text IS NOT NULL""")
def text_statistics(spark: SparkSession, base: str) -> DataFrame:
    text = F.col("text")
    rows = table(spark, base, "documents").where(text.isNotNull())
    counts = T.particle_counts(text)
    return rows.select("doc_id", *(c.cast("bigint").alias(n) for c, n in ((T.han_count(text), "han"), (counts["mandarin"], "mandarin"), (counts["cantonese"], "cantonese"), (T.word_count(text), "words"))))


@query(f"""SELECT doc_id, round(coalesce((length(b) - length(regexp_replace(b, '{_HAN}', '', 'g')))::DOUBLE / nullif(length(b), 0), 0.0), 9) AS density
  FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '\\([^)]*\\)|（[^）]*）', '', 'g'), '\\[[^\\]\\n]+#[^\\]\\n]+\\]', '', 'g') AS b FROM documents WHERE text IS NOT NULL)""")
def han_density(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "documents").where(F.col("text").isNotNull()).select("doc_id", F.round(T.han_density(F.col("text")), 9).alias("density"))


@query()
def cantonese_verdicts(spark: SparkSession, base: str) -> DataFrame:
    """Whether each document in Cantonese passes as such, and why not."""
    rows = table(spark, base, "documents").where((F.lower("lang") == "yue") & F.col("text").isNotNull())
    verdict = T.cantonese_verdict(F.col("text"))
    return rows.select("doc_id", verdict["passed"].alias("passed"), F.array_join(verdict["reasons"], "; ").alias("reasons"))


@query(f"""SELECT line, count(DISTINCT doc_id) AS documents FROM (SELECT doc_id, regexp_replace(l, '^{_WS}+|{_WS}+$', '', 'g') AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents)) WHERE line <> '' GROUP BY line HAVING count(DISTINCT doc_id) > 1""")
def repeated_document_lines(spark: SparkSession, base: str) -> DataFrame:
    lines = table(spark, base, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).withColumn("line", T.trimmed(F.col("line"))).where("line <> ''")
    return lines.distinct().groupBy("line").agg(F.count("*").alias("documents")).where("documents > 1")


@query("""SELECT doc_id, i AS slice_no, substr(text, i * 500 + 1, 500) AS slice FROM (SELECT doc_id, text, unnest(range(0, ceil(length(text) / 500.0)::BIGINT)) AS i FROM documents WHERE length(text) > 0)""")
def hard_slices(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "documents").where(F.length("text") > 0)
    return rows.select("doc_id", F.posexplode(T.hard_split(F.col("text"), 500)).alias("slice_no", "slice")).withColumn("slice_no", F.col("slice_no").cast("bigint"))


@query()
def packed_documents(spark: SparkSession, base: str) -> DataFrame:
    """Documents' paragraphs packed to chunks, without and with overlap."""
    rows = table(spark, base, "documents").where(F.col("text").isNotNull())
    return rows.select("doc_id", F.size(T.packed_paragraphs(T.paragraphs(F.col("text")), 2000)).alias("chunks"), F.size(T.overlapped_chunks(F.col("text"), 2000)).alias("overlapped"))


@query("""SELECT doc_id, CASE WHEN n = 0 THEN 0 ELSE greatest(1, floor(n / 1.5))::BIGINT END AS tokens, (ceil(n * 1.6) + 256)::BIGINT AS needed,
  CASE WHEN ceil(n * 1.6) + 256 > 8192 THEN 8192 ELSE ceil(n * 1.6) + 256 END::BIGINT AS max_tokens, least(greatest(floor(greatest(400, floor(n * 0.05)) / 3) + 80, 256), 900)::BIGINT AS summary_tokens
  FROM (SELECT doc_id, length(text) AS n FROM documents WHERE text IS NOT NULL)""")
def token_budgets(spark: SparkSession, base: str) -> DataFrame:
    n = F.length("text")
    wide = n * 1.6
    return table(spark, base, "documents").where(F.col("text").isNotNull()).select(
        "doc_id", budget.estimate_tokens(n, 1.5).cast("bigint").alias("tokens"), budget.needed_tokens(wide, 1.0).cast("bigint").alias("needed"),
        budget.max_tokens(wide, 1.0, F.lit(10)).cast("bigint").alias("max_tokens"), budget.summary_tokens(n).cast("bigint").alias("summary_tokens"),
    )


# --- facts ----------------------------------------------------------------------------------------


def _names() -> Column:
    return F.regexp_extract_all("text", F.lit(f"[{T.HAN}]{{1,4}}·[{T.HAN}]{{1,4}}"), F.lit(0))


@query(f"SELECT name, count(*) AS mentions, count(DISTINCT id) AS sections FROM (SELECT id, unnest(regexp_extract_all(text, '{_HAN}{{1,4}}·{_HAN}{{1,4}}')) AS name FROM {_SECTIONS}) GROUP BY name")
def name_mentions(spark: SparkSession, base: str) -> DataFrame:
    names = of_sections(spark, base, id="id", names=_names()).select("id", F.explode("names").alias("name"))
    return names.groupBy("name").agg(F.count("*").alias("mentions"), F.countDistinct("id").alias("sections"))


@query()
def coverage_tokens(spark: SparkSession, base: str) -> DataFrame:
    """The facts of each section that is no duplicate, by family."""
    rows = balanced(originals(table(spark, base, "sections")).where(F.col("text").isNotNull()).select("id", "text"))
    found = rows.select("id", coverage.token_families(F.col("text")).alias("f"))
    return found.select("id", *(F.size(f"f.{name}").alias(name) for name in coverage.FAMILIES), F.array_join(coverage.flat_tokens(F.col("f")), "|").alias("tokens")).distinct()


@query(f"""SELECT c.id, n.name FROM {_SECTIONS} c JOIN (SELECT DISTINCT id AS oid, unnest(regexp_extract_all(text, '{_HAN}{{1,4}}·{_HAN}{{1,4}}')) AS name FROM {_SECTIONS}) n ON c.duplicate_of = n.oid
  WHERE c.id <> c.duplicate_of AND c.text IS NOT NULL AND NOT contains(c.text, n.name)""")
def missing_names(spark: SparkSession, base: str) -> DataFrame:
    """Names of a section that a section marked as its duplicate doesn't hold."""
    rows = table(spark, base, "sections")
    copies = rows.where((F.col("id") != F.col("duplicate_of")) & F.col("text").isNotNull()).select("id", "text", "duplicate_of")
    required = of_sections(spark, base, oid="id", required=F.array_distinct(_names()))
    both = copies.join(required, F.col("duplicate_of") == F.col("oid"))
    return both.select("id", F.explode(F.filter("required", lambda t: ~F.contains(F.col("text"), t))).alias("name")).distinct()


# --- order within sources -------------------------------------------------------------------------


@query(f"""SELECT id, source_stem, start_line, coalesce(lead(start_line) OVER (PARTITION BY source_stem ORDER BY start_line, id) - 1, last) AS end_line
  FROM (SELECT *, max(end_line) OVER (PARTITION BY source_stem) AS last FROM {_SECTIONS}) WHERE level = 1""")
def segment_bounds(spark: SparkSession, base: str) -> DataFrame:
    """Sections of level 1 with the line before the next one."""
    rows = first_deliveries(table(spark, base, "sections"), "source_stem", "start_line", "end_line", "level")
    last = rows.groupBy("source_stem").agg(F.max("end_line").alias("last"))
    firsts = blocked(rows.where("level = 1"), "source_stem", "start_line", "id")
    begins = firsts.groupBy("_group", "_block").agg(F.min_by("start_line", "_n").alias("first"))
    following = begins.select("_group", "_block", F.lead("first").over(over_blocks()).alias("following"))
    ends = firsts.withColumn("next", F.lead("start_line").over(in_block())).join(following, ["_group", "_block"]).join(last, "source_stem")
    return ends.select("id", "source_stem", "start_line", F.coalesce(F.coalesce("next", "following") - 1, "last").alias("end_line"))


@query(f"SELECT id, coalesce(last_value(source_book IGNORE NULLS) OVER (PARTITION BY source_stem ORDER BY ord ROWS UNBOUNDED PRECEDING), source_stem) AS book FROM {_SECTIONS}")
def as_of_books(spark: SparkSession, base: str) -> DataFrame:
    rows = first_deliveries(table(spark, base, "sections"), "source_stem", "source_book")
    return sections.as_of_label(rows, "source_stem", "ord", "source_book", "book").select("id", "book")


@query(f"""SELECT source_stem, min(ord) AS ord, count(*) AS merged, min(start_line) AS start_line, max(end_line) AS end_line, sha256(string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY ord)) AS text_hash FROM
  (SELECT *, sum(fresh) OVER (PARTITION BY source_stem ORDER BY ord ROWS UNBOUNDED PRECEDING) AS island FROM
  (SELECT *, CASE WHEN row_number() OVER w > 1 AND heading_path[1] IS NOT DISTINCT FROM lag(heading_path[1]) OVER w AND kind IS NOT DISTINCT FROM lag(kind) OVER w THEN 0 ELSE 1 END AS fresh FROM {_SECTIONS}
  WINDOW w AS (PARTITION BY source_stem ORDER BY ord))) GROUP BY source_stem, island""")
def merged_neighbours(spark: SparkSession, base: str) -> DataFrame:
    """Neighbouring sections of one chapter and kind joined."""
    rows = first_deliveries(table(spark, base, "sections"), "source_stem", "heading_path", "kind", "text", "start_line", "end_line").withColumn("chapter", F.try_element_at("heading_path", F.lit(1)))
    out = sections.merge_adjacent(rows, "source_stem", "ord", ["chapter", "kind"], "text", "start_line", "end_line")
    return out.select("source_stem", "ord", "merged", "start_line", "end_line", F.sha2("text", 256).alias("text_hash"))


@query(f"SELECT id, floor((row_number() OVER (ORDER BY id) - 1) / 40)::BIGINT AS batch FROM {_SECTIONS}")
def heading_batches(spark: SparkSession, base: str) -> DataFrame:
    return outline.batches(table(spark, base, "sections").select("id").distinct(), "id").select("id", F.col("batch").cast("bigint").alias("batch"))


@query()
def heading_packs(spark: SparkSession, base: str) -> DataFrame:
    """Headings of each bucket packed under a cap of tokens: rows and packs."""
    rows = first_deliveries(table(spark, base, "sections"), "heading_path", "source_stem").withColumn("heading_path", F.coalesce("heading_path", F.array().cast("array<string>")))
    lined = rows.select("id", inventory.primary_bucket(F.col("heading_path"), inventory.LEXICON).alias("bucket"), "ord", inventory.heading_line(F.col("source_stem"), F.col("heading_path"), inventory.keywords(F.col("heading_path"), inventory.LEXICON), F.lit("")).alias("line"))
    packed = inventory.packed_headings(lined, "bucket", "ord", "line", cap=2000)
    return packed.groupBy("bucket", "pack.block", "pack.pack").agg(F.count("*").alias("rows"), F.sum(F.length("line")).alias("chars"))


# --- groups of a node -----------------------------------------------------------------------------


def _assigned(spark: SparkSession, base: str, **columns: Column | str) -> DataFrame:
    """Sections, with these columns, assigned to the node of their bucket."""
    node = F.concat(F.lit("s-"), inventory.primary_bucket(_path(), inventory.LEXICON))
    assignments = of_sections(spark, base, section_id="id", primary_node_id=node).withColumn("ord", F.lit(0))
    return merge.gathered(assignments, of_sections(spark, base, id="id", kind="kind", **columns))


@query(f"""SELECT 's-' || {_bucket()} AS node_id, count(*) AS members, sum(length(text))::BIGINT AS chars, count(DISTINCT source_stem) AS stems FROM {_SECTIONS} WHERE kind IN ('body', 'preface', 'skill_test') GROUP BY ALL""")
def gathered_members(spark: SparkSession, base: str) -> DataFrame:
    rows = _assigned(spark, base, chars=F.length("text"), source_stem="source_stem")
    return rows.groupBy("node_id").agg(F.count("*").alias("members"), F.sum("chars").alias("chars"), F.countDistinct("source_stem").alias("stems"))


@query(f"""SELECT node_id, count(*) AS members FROM (SELECT *, max(CASE WHEN duplicate_of IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY node_id, k) AS has FROM
  (SELECT 's-' || {_bucket()} AS node_id, heading_path[1] AS k, CASE WHEN duplicate_of <> id AND duplicate_of IN (SELECT id FROM sections WHERE kind IN ('body', 'preface', 'skill_test')) THEN duplicate_of END AS duplicate_of FROM {_SECTIONS} WHERE kind IN ('body', 'preface', 'skill_test'))) WHERE duplicate_of IS NULL OR has = 0 GROUP BY node_id""")
def unique_members(spark: SparkSession, base: str) -> DataFrame:
    rows = _assigned(spark, base, duplicate_of="duplicate_of", k=F.coalesce(F.try_element_at("heading_path", F.lit(1)), F.lit("\x00")))
    return merge.unique_members(merge.true_links(rows), ["node_id", "k"]).groupBy("node_id").agg(F.count("*").alias("members"))


@query()
def required_facts(spark: SparkSession, base: str) -> DataFrame:
    """The facts that the merged text of each group of a heading must keep, among members that are no duplicates."""
    rows = _assigned(spark, base, text="text", duplicate_of="duplicate_of", chapter=F.slice(_path(), 1, 1)).where(F.col("text").isNotNull()).withColumn("heading", T.heading_path_key(F.col("chapter")))
    found = merge.required_token_rows(merge.true_links(rows), ["node_id", "heading"])
    return found.groupBy("node_id", "heading").agg(F.count("*").alias("facts"))


@query(f"""SELECT round(median(r), 9) AS median_ratio, round(median(o), 9) AS median_overlap, coalesce(median(r) < 0.5 AND median(o) < 0.3, false) AS failed FROM
  (SELECT out_chars::DOUBLE / nullif(union_chars, 0) AS r, overlap AS o FROM (SELECT source_stem, max(length(text)) AS out_chars, sum(length(text)) AS union_chars, count(duplicate_of)::DOUBLE / count(*) AS overlap FROM {_SECTIONS} GROUP BY source_stem))""")
def size_canary(spark: SparkSession, base: str) -> DataFrame:
    """The canary of merged sizes, with each source as a node, its longest text as what was merged."""
    rows = of_sections(spark, base, id="id", source_stem="source_stem", size=F.length("text"), duplicate_of="duplicate_of")
    meta = rows.groupBy("source_stem").agg(F.max("size").alias("out_chars"), F.sum("size").alias("union_chars"), (F.count("duplicate_of") / F.count("*")).alias("overlap"))
    return merge.canary(meta).select(F.round("median_ratio", 9).alias("median_ratio"), F.round("median_overlap", 9).alias("median_overlap"), "failed")


# --- similarity -----------------------------------------------------------------------------------


@query(f"""SELECT id, round(CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 0.0 ELSE len(list_intersect(a, b))::DOUBLE / len(list_distinct(list_concat(a, b))) END, 9) AS jaccard FROM
  (SELECT x.id, list_distinct(list_transform(range(1, greatest(length(x.t) - 3, 1)), lambda i: substr(x.t, i, 5))) AS a, list_distinct(list_transform(range(1, greatest(length(y.t) - 3, 1)), lambda i: substr(y.t, i, 5))) AS b FROM
  (SELECT *, regexp_replace(text, '{_WORDS}', '', 'g') AS t FROM {_SECTIONS}) x JOIN (SELECT *, regexp_replace(text, '{_WORDS}', '', 'g') AS t FROM {_SECTIONS}) y ON x.duplicate_of = y.id WHERE x.id <> y.id AND x.t IS NOT NULL AND y.t IS NOT NULL)""")
def duplicate_similarity(spark: SparkSession, base: str) -> DataFrame:
    """How similar each section is to the one it is marked as a duplicate of."""
    rows = table(spark, base, "sections").where(F.col("text").isNotNull()).select("id", "duplicate_of", F.regexp_replace("text", T.NOT_WORD, "").alias("t"))
    copies = rows.where(F.col("id") != F.col("duplicate_of"))
    wanted = copies.select(F.col("duplicate_of").alias("id")).distinct()
    other = rows.join(wanted, "id", "left_semi").select(F.col("id").alias("oid"), F.col("t").alias("u")).dropDuplicates(["oid"])
    both = copies.dropDuplicates(["id"]).join(other, F.col("duplicate_of") == F.col("oid"))
    return both.select("id", F.round(similarity.exact_jaccard(similarity.shingle_set(F.col("t")), similarity.shingle_set(F.col("u"))), 9).alias("jaccard"))


@query(f"""WITH RECURSIVE e AS (SELECT DISTINCT a.id AS x, a.duplicate_of AS y FROM sections a SEMI JOIN sections b ON a.duplicate_of = b.id WHERE a.id <> a.duplicate_of),
  u AS (SELECT x, y FROM e UNION SELECT y, x FROM e), r AS (SELECT x AS node, x AS seen FROM u UNION SELECT r.node, u.y FROM r JOIN u ON r.seen = u.x) SELECT node AS id, min(seen) AS component FROM r GROUP BY node""")
def duplicate_of_components(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "sections")
    ids = rows.select(F.col("id").alias("duplicate_of")).distinct()
    links = rows.where(F.col("id") != F.col("duplicate_of")).select("id", "duplicate_of").distinct().join(ids, "duplicate_of", "left_semi")
    return connected_components(links, "id", "duplicate_of").withColumnRenamed("node", "id")


@query()
def minhash_signatures(spark: SparkSession, base: str) -> DataFrame:
    signed = similarity.signatures(balanced(table(spark, base, "sections").select("id", "text")))
    return signed.select("id", F.size("signature").alias("slots"), F.array_join("signature", ",").alias("signature")).distinct()


def _overlap(spark: SparkSession, base: str, least: float = similarity.OVERLAP) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, base, "sections").select("id", "text", "source_stem", F.length("text").alias("char_count"))
    return rows, materialize(similarity.overlap_pairs(rows, least=least), "pairs")


@query()
def overlap_pairs(spark: SparkSession, base: str) -> DataFrame:
    return _overlap(spark, base)[1]


@query()
def overlap_components(spark: SparkSession, base: str) -> DataFrame:
    rows, pairs = _overlap(spark, base, similarity.EXACTISH)  # it uses no other pairs
    return similarity.duplicate_components(rows, pairs)


@query()
def dominant_stem_pair(spark: SparkSession, base: str) -> DataFrame:
    return similarity.dominant_stem_pair(*_overlap(spark, base, similarity.EXACTISH))  # it uses no other pairs


# --- outlines and documents -----------------------------------------------------------------------


@query(f"""SELECT bucket, 1::BIGINT AS parts, count(DISTINCT c) AS chapters, count(DISTINCT c || chr(1) || s) AS sections FROM (SELECT {_bucket()} AS bucket,
  {{}} AS c, {{}} AS s FROM {_SECTIONS}) GROUP BY bucket""".format(*(f"coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(heading_path[{i}], '[*_`]+', '', 'g'), '{_WS.replace('{', '{{').replace('}', '}}')}+', ' ', 'g'), '^ | $', '', 'g'), ''), 'body')".replace("{{", "{").replace("}}", "}") for i in (1, 2))))
def outline_counts(spark: SparkSession, base: str) -> DataFrame:
    """Parts, chapters and sections of the fallback outline of each bucket."""
    rows = first_deliveries(table(spark, base, "sections"), "heading_path").withColumn("heading_path", _path())
    return outline.counts(outline.fallback_outline(rows, inventory.LEXICON), "bucket")


@query()
def preseeded_headings(spark: SparkSession, base: str) -> DataFrame:
    """Headings that the outline's titles place without a model."""
    rows = of_sections(spark, base, section_id="id", heading_path=_path())
    flat = spark.createDataFrame([(f"s-{b.replace('_', '-')}", b.replace("_", " ").title(), ps[0]) for b, ps in inventory.LEXICON.items()], "node_id string, title_en string, title_zh string")
    matched = outline.bucket_nodes(flat, inventory.lexicon_rows(spark, inventory.LEXICON))
    return outline.preseeded(rows, matched, inventory.LEXICON)


@query("""SELECT cache_key, json_array_length(response_text, '$.assignments')::BIGINT AS rows FROM (SELECT DISTINCT cache_key, response_text FROM llm_cache WHERE key.stage = 'assign') WHERE json_valid(response_text) AND json_array_length(response_text, '$.assignments') > 0""")
def parsed_assignments(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "llm_cache").where("key.stage = 'assign'").select("cache_key", "response_text").distinct()
    parsed = rows.withColumn("found", outline.parse_assignments(F.col("response_text")))
    return parsed.where(F.col("found").isNotNull()).select("cache_key", F.size("found").cast("bigint").alias("rows"))


@query()
def parsed_merges(spark: SparkSession, base: str) -> DataFrame:
    """Merge answers cut into text and conflicts, and the headings of the text."""
    rows = table(spark, base, "llm_cache").where("key.stage = 'merge'").select("cache_key", "response_text").dropDuplicates(["cache_key"])
    parsed = rows.withColumn("m", outline.parse_merge_output(F.col("response_text"))).where(F.col("m").isNotNull())
    return parsed.select("cache_key", F.length("m.markdown").alias("chars"), F.size("m.conflicts").alias("conflicts"), F.size(T.headings(F.col("m.markdown"))).alias("headings"))


def _volumes(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with ``volume``: a source's document is cut after so many sections, so that one that holds a third of all rows is no single value."""
    return blocked(rows, "source_stem", *order).withColumnRenamed("_block", "volume")


_VOLUME = f"floor((row_number() OVER (PARTITION BY source_stem ORDER BY {{}}) - 1) / {BLOCK})::BIGINT AS volume"


@query(f"""SELECT source_stem, volume, length(t)::BIGINT AS chars, sha256(t) AS document_hash FROM (SELECT source_stem, volume, string_agg(repeat('#', least(coalesce(level, 1) + 1, 6)) || ' ' || coalesce(heading_path[-1], '') || chr(10) || chr(10) || coalesce(text, ''), chr(10) || chr(10) ORDER BY ord) AS t FROM (SELECT *, {_VOLUME.format('ord')} FROM {_SECTIONS}) GROUP BY source_stem, volume)""")
def assembled_books(spark: SparkSession, base: str) -> DataFrame:
    """Each source as one document."""
    rows = first_deliveries(table(spark, base, "sections"), "source_stem", "level", "heading_path", "text")
    block = F.concat(F.repeat(F.lit("#"), F.least(F.coalesce("level", F.lit(1)) + 1, F.lit(6))), F.lit(" "), F.coalesce(F.try_element_at("heading_path", F.lit(-1)), F.lit("")), F.lit("\n\n"), F.coalesce("text", F.lit("")))
    out = assemble.ordered_text(_volumes(rows.withColumn("block", block), "ord"), ["source_stem", "volume"], ["ord"], "block")
    return out.select("source_stem", "volume", F.length("text").cast("bigint").alias("chars"), F.sha2("text", 256).alias("document_hash"))


@query(f"""SELECT source_stem, volume, sha256(string_agg('### ' || array_to_string(heading_path, ' / ') || chr(10) || chr(10) || coalesce(text, ''), chr(10) || chr(10) ORDER BY start_line, id)) AS quiz_hash
  FROM (SELECT *, {_VOLUME.format('start_line, id')} FROM {_SECTIONS} WHERE kind = 'quiz') GROUP BY source_stem, volume""")
def quiz_appendix(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "sections").where("kind = 'quiz'").select("id", "source_stem", "kind", "heading_path", "text", "start_line").distinct()
    return assemble.quizzes(_volumes(rows, "start_line", "id"), ["source_stem", "volume"]).select("source_stem", "volume", F.sha2("text", 256).alias("quiz_hash"))


@query(f"""SELECT title, count(*) AS mentions FROM (SELECT unnest(regexp_extract_all(text, '《([^》]{{1,80}})》', 1)) AS title FROM (SELECT text FROM {_SECTIONS} WHERE kind = 'bibliography' UNION ALL SELECT text FROM (SELECT DISTINCT * FROM dropped))) GROUP BY title""")
def cited_titles(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "sections").where("kind = 'bibliography'").select("id", "kind", "text")
    return assemble.cited_titles(rows, table(spark, base, "dropped"))


@query()
def document_faults(spark: SparkSession, base: str) -> DataFrame:
    """Each source assembled with a table of contents, and what the finished document fails."""
    rows = first_deliveries(table(spark, base, "sections"), "source_stem", "level", "heading_path", "text")
    head = F.concat(F.repeat(F.lit("#"), F.least(F.coalesce("level", F.lit(1)) + 1, F.lit(6))), F.lit(" "), F.coalesce(F.try_element_at("heading_path", F.lit(-1)), F.lit("")))
    body = assemble.ordered_text(_volumes(rows.withColumn("block", F.concat(head, F.lit("\n\n"), F.coalesce("text", F.lit("")))), "ord"), ["source_stem", "volume"], ["ord"], "block")
    whole = assemble.document(F.col("text"), F.col("source_stem"), "目录", assemble.front_matter({"title": F.col("source_stem"), "language": F.lit("zh")}))
    return body.select("source_stem", "volume", F.array_join(assemble.document_faults(whole, "zh", "目录"), "; ").alias("faults"))


# --- cache and model calls ------------------------------------------------------------------------


@query("""SELECT round(CASE WHEN count(*) >= 5 THEN avg(length(response_text)::DOUBLE / output_tokens) ELSE 1.0 END, 6) AS chars_per_token, count(*) AS samples FROM (SELECT DISTINCT cache_key, response_text, output_tokens FROM llm_cache) WHERE output_tokens > 0 AND length(response_text) > 0""")
def token_rate(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "llm_cache").select("cache_key", "response_text", "output_tokens").distinct()
    return merge.token_rate(rows.withColumn("chars_out", F.length("response_text"))).select(F.round("chars_per_token", 6).alias("chars_per_token"), "samples")


@query("SELECT stage, count(*) AS calls, count(k) AS hits FROM (SELECT c.stage, h.cache_key AS k FROM (SELECT DISTINCT cache_key, stage FROM llm_calls) c LEFT JOIN (SELECT DISTINCT cache_key FROM llm_cache WHERE finish_reason = 'stop') h USING (cache_key)) GROUP BY stage")
def cache_hits(spark: SparkSession, base: str) -> DataFrame:
    calls = table(spark, base, "llm_calls").select("cache_key", "stage").distinct()
    hits = table(spark, base, "llm_cache").where("finish_reason = 'stop'").select("cache_key", F.lit(1).alias("hit")).distinct()
    return calls.join(hits, "cache_key", "left").groupBy("stage").agg(F.count("*").alias("calls"), F.count("hit").alias("hits"))


@query("SELECT DISTINCT cache_key, key.stage AS stage, length(response_text)::BIGINT AS chars FROM llm_cache")
def cache_compacted(spark: SparkSession, base: str) -> DataFrame:
    return compacted(table(spark, base, "llm_cache")).select("cache_key", "key.stage", F.length("response_text").cast("bigint").alias("chars"))


@query("""SELECT c.cache_key, CASE WHEN h.cache_key IS NULL THEN 'called' ELSE 'cached' END AS origin, length(CASE WHEN h.cache_key IS NULL THEN 'echo: ' || substr(c.user_text, 1, 20) ELSE h.response_text END)::BIGINT AS chars
  FROM (SELECT DISTINCT cache_key, user_text FROM llm_calls) c LEFT JOIN (SELECT DISTINCT cache_key, response_text FROM llm_cache WHERE finish_reason = 'stop') h USING (cache_key)""")
def provider_answers(spark: SparkSession, base: str) -> DataFrame:
    """Every call answered: from the cache where it ended well, else by a fake model."""
    calls = table(spark, base, "llm_calls").select("cache_key", "user_text").distinct()
    requests = calls.select("cache_key", F.lit("").alias("system"), "user_text", F.lit(0.2).alias("temperature"), F.lit(900).alias("max_tokens"), F.lit(False).alias("json_mode"))
    cache = table(spark, base, "llm_cache").where("finish_reason = 'stop'")
    answers, new = completed(requests, cache, FakeProvider(lambda system, user: "echo: " + user[:20]))
    made = new.select("cache_key", F.lit("called").alias("origin"))
    return answers.join(made, "cache_key", "left").select("cache_key", F.coalesce("origin", F.lit("cached")).alias("origin"), F.length("response_text").cast("bigint").alias("chars"))


# --- relational operators on the star schema ---------------------------------------------------------


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_discount), 6) AS avg_disc, count(*) AS orders
  FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def pricing_summary(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    price = F.col("l_extendedprice")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(price), 2).alias("sum_base"), F.round(F.sum(price * (1 - F.col("l_discount"))), 2).alias("sum_disc"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("orders")
    )


@query("""SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
  JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""")
def local_supplier_revenue(spark: SparkSession, base: str) -> DataFrame:
    t = lambda name: table(spark, base, name)
    joined = (
        t("lineitem").select("l_orderkey", "l_suppkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
        .join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("supplier").select("s_suppkey", "s_nationkey"), (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
        .join(t("nation").select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.groupBy("n_name").agg(F.round(F.sum("r"), 2).alias("revenue"))


@query("""SELECT o_orderpriority, o_orderstatus, grouping(o_orderpriority)::INT AS g1, grouping(o_orderstatus)::INT AS g2, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)""")
def order_rollup(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "orders").rollup("o_orderpriority", "o_orderstatus").agg(
        F.grouping("o_orderpriority").cast("int").alias("g1"), F.grouping("o_orderstatus").cast("int").alias("g2"), F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("SELECT c_nationkey, c_custkey, c_acctbal, rn AS place FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn <= 3")
def richest_customers(spark: SparkSession, base: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey"))
    return table(spark, base, "customer").withColumn("place", place).where("place <= 3").select("c_nationkey", "c_custkey", "c_acctbal", F.col("place").cast("bigint").alias("place"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def customers_without_orders(spark: SparkSession, base: str) -> DataFrame:
    orders = table(spark, base, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, base, "customer").select("c_custkey").join(orders, "c_custkey", "left_anti")


@query("SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def daily_events(spark: SparkSession, base: str) -> DataFrame:
    return windowed_counts(table(spark, base, "events"), "ts", "event_type", "value").select("window_start", "event_type", "n", F.round("total", 4).alias("total"))


@query("""SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 30 MINUTE AS ended, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM
  (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s""")
def event_sessions(spark: SparkSession, base: str) -> DataFrame:
    return sessions(table(spark, base, "events"), "ts", "user_id")


def _details() -> None:
    """Adds the queries of the single functions, and the SQL they share with queries here."""
    from lectern.queries import details

    _SQL.update(section_kinds=details.SECTION_KINDS, parsed_merges=details.PARSED_MERGES, preseeded_headings=details.PRESEEDED)


def queries() -> dict[str, Query]:
    _details()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _details()
    return dict(_SQL)
