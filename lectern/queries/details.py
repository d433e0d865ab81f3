"""Queries of the single functions of text, headings, budgets, outlines and answers over whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import budget, predicates
from lectern.functions import text as T
from lectern.functions.scripts import SIMPLIFIED_ONLY, TO_TRADITIONAL
from lectern.operators import assemble, inventory, merge, outline
from lectern.plans.provider import cache_key, filled
from lectern.queries.catalogue import _HAN, _SECTIONS, _WS, first_deliveries, of_sections, query
from lectern.session import table

_BLANK = r"[ \t\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
_NL = "chr(10)"
_RULE = rf"^{_WS}*(?:-{{3,}}|\*{{3,}}|_{{3,}}){_WS}*$"
_ITEM = rf"^{_WS}*(?:[-*+]|[0-9]+[.)、]|[一二三四五六七八九十]+、){_WS}+.*\S"
_META = r"(?i:ISBN)|版权所有|图书在版编目|责任编辑|责任印制|出版发行|中国版本图书馆|(?:^|[^\p{L}\p{N}_])CIP(?:[^\p{L}\p{N}_]|$)|\*\*[^*]{1,12}：\*\*"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _normal(x: str) -> str:
    """A title as it is compared, for titles that NFKC doesn't change."""
    return _trim(f"regexp_replace(regexp_replace({x}, '[*_`]+', '', 'g'), '{_WS}+', ' ', 'g')")


def _key(x: str) -> str:
    return f"lower(regexp_replace(regexp_replace({_normal(x)}, '{_WS}+', '', 'g'), '[：:、，。！？!?,;；—–_·•\\.．-]+', '', 'g'))"


def _visible(x: str) -> str:
    bare = f"regexp_replace({_trim(x)}, '^#+{_WS}*', '')"
    bare = f"regexp_replace({bare}, '^(?:[-*+]|[0-9]+[.)、]|[一二三四五六七八九十]+、){_WS}+', '')"
    for mark in (r"\*\*", "__", r"\*", "_"):
        bare = f"regexp_replace({bare}, '^{mark}(.*){mark}$', '\\1')"
    return _trim(bare)


def _any(words: tuple[str, ...]) -> str:
    return "|".join(words)


def _in(words: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


# --- titles, lines and paragraphs -----------------------------------------------------------------

_TITLES = "(SELECT DISTINCT t FROM (SELECT heading AS t FROM dropped UNION ALL SELECT unnest(heading_path) FROM sections) WHERE t IS NOT NULL)"


def _titles(spark: SparkSession, base: str) -> DataFrame:
    paths = table(spark, base, "sections").select(F.explode("heading_path").alias("t"))
    return table(spark, base, "dropped").select(F.col("heading").alias("t")).unionAll(paths).where(F.col("t").isNotNull()).distinct()


_HEAD = "translate({}, ' ', '')"
_MATTER = f"(k IN {_in(('preface', *predicates.BIBLIOGRAPHY_WORDS))} OR contains(k, '后记') OR regexp_matches(substr(replace(n, ' ', ''), 1, 8), '{_any(predicates.PREFACE_WORDS)}'))"
_NUMBER = r"regexp_extract(n, '^(\p{Nd}+(?:[.．-]\p{Nd}+)+)(?:[^\p{L}\p{N}_]|$)', 1)"
_DEPTH = f"(CASE WHEN {_NUMBER} <> '' THEN len(regexp_extract_all({_NUMBER}, '[.．-]')) + 1 END)"


@query(f"""SELECT t AS title, n AS normal, k AS key, {_trim("regexp_replace(replace(regexp_replace(t, '[*_`]+', '', 'g'), chr(12288), ' '), ' +', ' ', 'g')")} AS shown,
  k IN {_in(predicates.TOC_KEYS)} AS contents, k = 'preface' OR regexp_matches(substr(replace(n, ' ', ''), 1, 6), '{_any(predicates.PREFACE_WORDS)}') AS preface, regexp_matches(k, '^(?:{_any(predicates.BIBLIOGRAPHY_WORDS)})') AS bibliography,
  starts_with(k, '出版说明') AS note, k IN {_in(predicates.COPYRIGHT_KEYS)} OR contains(k, '图书在版编目') OR starts_with(k, 'cip') AS rights, k = '封面' AS cover, contains(k, '后记') AS afterword FROM (SELECT t, {_normal('t')} AS n, {_key('t')} AS k FROM {_TITLES})""")
def title_keys(spark: SparkSession, base: str) -> DataFrame:
    """Every distinct title as shown, normalized and as a key, and what its key says."""
    t = F.col("t")
    return _titles(spark, base).select(
        t.alias("title"), T.normalize_title(t, True).alias("normal"), T.compact_key(t, True).alias("key"), T.display_title(t).alias("shown"), predicates.is_contents_heading(t).alias("contents"), predicates.is_preface_heading(t).alias("preface"),
        predicates.is_bibliography_heading(t).alias("bibliography"), predicates.is_publisher_note(t).alias("note"), predicates.is_copyright_heading(t).alias("rights"), predicates.is_cover(t).alias("cover"), predicates.is_afterword(t).alias("afterword"),
    )


@query(f"""SELECT t AS title, {_MATTER} AS matter, regexp_matches(t, '^心理测试[\\s\\x{{3000}}:：]+.+$') AS magazine_quiz,
  CASE WHEN regexp_matches(n, '{predicates.CHAPTER}') OR {_MATTER} THEN 1 WHEN regexp_matches(n, '{predicates.SECTION}') THEN 2 ELSE coalesce({_DEPTH}, 3) END::BIGINT AS level,
  length(t) <= 40 AND NOT regexp_matches(n, '{predicates.CHAPTER}') AND NOT regexp_matches(n, '{predicates.SECTION}') AND NOT {_MATTER} AND {_DEPTH} IS NULL AS topical FROM (SELECT t, {_normal('t')} AS n, {_key('t')} AS k FROM {_TITLES})""")
def title_levels(spark: SparkSession, base: str) -> DataFrame:
    """Where every distinct title stands in a book's structure, as a heading of level 3 or, for topics, of level 1."""
    t = F.col("t")
    return _titles(spark, base).select(
        t.alias("title"), predicates.is_front_or_back_matter(t).alias("matter"), predicates.is_magazine_quiz(t).alias("magazine_quiz"), predicates.structural_level(t, F.lit(3)).cast("bigint").alias("level"), predicates.is_short_topical(t, F.lit(1)).alias("topical")
    )


_LINES = f"(SELECT DISTINCT unnest(string_split(text, {_NL})) AS line FROM (SELECT text FROM dropped UNION ALL SELECT text FROM sections UNION ALL SELECT '- **' || heading || '**' FROM dropped UNION ALL SELECT '  ***  '))"


@query(f"""SELECT line, {_visible('line')} AS visible, regexp_matches(line, '{_RULE}') AS rule, {_visible('line')} = '返回总目录' AS returns, {_visible('line')} = '返回总目录' AND NOT regexp_matches(line, '{_ITEM}') AS returns_alone, regexp_matches(line, '{_META}') AS metadata FROM {_LINES}""")
def line_kinds(spark: SparkSession, base: str) -> DataFrame:
    """Every distinct line of sections and dropped parts as a reader sees it, and what kind of line it is."""
    dropped = table(spark, base, "dropped")
    texts = dropped.select("text").unionAll(table(spark, base, "sections").select("text")).unionAll(dropped.select(F.concat(F.lit("- **"), "heading", F.lit("**")))).unionAll(spark.createDataFrame([("  ***  ",)], "text string"))
    line = F.col("line")
    return texts.select(F.explode(F.split("text", "\n")).alias("line")).distinct().select(
        "line", T.visible_line(line).alias("visible"), predicates.is_rule(line).alias("rule"), predicates.returns_to_contents(line).alias("returns"), predicates.returns_to_contents_alone(line).alias("returns_alone"), predicates.is_metadata_line(line).alias("metadata")
    )


_PARAS = rf"list_filter(list_transform(regexp_split_to_array(text, '\n{_WS}*\n'), lambda x: regexp_replace(x, '^\n+|\n+$', '', 'g')), lambda x: {_trim('x')} <> '')"
_CUE = f"regexp_matches(p, '{predicates.CUES}')"


@query(rf"""SELECT DISTINCT p AS paragraph, regexp_matches(p, '(?i:ISBN)|版权所有|责任印制|责任编辑|限于时间和水平') AS colophon, regexp_matches(p, '{predicates.SALES}') AS sales,
  regexp_matches(p, '(?:^|[^\p{{L}}\p{{N}}_])CIP(?:[^\p{{L}}\p{{N}}_]|$)|CIP数据|图书在版编目') OR (regexp_matches(p, '(?i)ISBN') AND regexp_matches(p, '版权所有|责任编辑|责任印制')) AS imprint,
  regexp_matches(p, '7{_WS}*[%％].{{0,40}}38.{{0,40}}55|7.{{0,20}}38.{{0,20}}55.{{0,20}}[%％]') OR (regexp_matches(p, '[“"「].+[”"」]') AND {_CUE}) OR regexp_matches(p, '(?:^|[^\p{{L}}\p{{N}}_])(?:METT|FACS)(?:[^\p{{L}}\p{{N}}_]|$)') OR (regexp_matches(p, '{_HAN}·{_HAN}') AND {_CUE}) AS instructional
  FROM (SELECT unnest({_PARAS}) AS p FROM (SELECT text FROM sections UNION ALL SELECT text FROM dropped))""")
def paragraph_kinds(spark: SparkSession, base: str) -> DataFrame:
    """Every distinct paragraph of sections and dropped parts, and what it is."""
    texts = table(spark, base, "sections").select("text").unionAll(table(spark, base, "dropped").select("text"))
    p = F.col("paragraph")
    return texts.select(F.explode(T.paragraphs(F.col("text"))).alias("paragraph")).distinct().select(
        "paragraph", predicates.is_colophon(p).alias("colophon"), predicates.is_sales_copy(p).alias("sales"), predicates.is_imprint_text(p).alias("imprint"), predicates.is_instructional(p).alias("instructional")
    )


@query(rf"""SELECT DISTINCT id, list_sum(list_transform(list_filter(string_split(text, {_NL}), lambda x: {_trim('x')} <> '' AND NOT regexp_matches(x, '{_RULE}') AND NOT regexp_matches(x, '{_ITEM}') AND NOT regexp_matches(x, '{_META}')), lambda x: length({_trim('x')}))) >= 40 IS TRUE AS prose,
  len(heading_path) > 1 AS below_chapter FROM {_SECTIONS} WHERE text IS NOT NULL AND len(heading_path) > 0""")
def prose_bodies(spark: SparkSession, base: str) -> DataFrame:
    """Whether each section has prose, and stands below a chapter."""
    rows = of_sections(spark, base, id="id", prose=predicates.has_prose(F.split("text", "\n")), below_chapter=predicates.path_is_under(F.col("heading_path"), F.slice("heading_path", 1, 1)), some=F.size("heading_path") > 0)
    return rows.where(F.col("prose").isNotNull() & F.col("some")).drop("some")


_BODY = f"(SELECT id, coalesce(level, 1) AS raw, coalesce(text, '') AS text, coalesce(heading_path[-1], '') AS t, {_normal("coalesce(heading_path[-1], '')")} AS n, {_key("coalesce(heading_path[-1], '')")} AS k FROM {_SECTIONS})"
SECTION_KINDS = rf"""SELECT id, CASE WHEN regexp_matches(k, '^(?:{_any(predicates.BIBLIOGRAPHY_WORDS)})') THEN 'bibliography'
  WHEN k = 'preface' OR regexp_matches(substr(replace(n, ' ', ''), 1, 6), '{_any(predicates.PREFACE_WORDS)}') OR contains(k, '后记') THEN 'preface' WHEN regexp_matches(t, '{predicates.SKILL_TEST}') THEN 'skill_test'
  WHEN contains(t, '心理测试') AND (contains(text, '结果分析') OR (regexp_matches(text, '(?:^|{_WS})A[.．、]') AND regexp_matches(text, '(?:^|{_WS})B[.．、]') AND regexp_matches(text, '(?:^|{_WS})C[.．、]'))) THEN 'quiz' ELSE 'body' END AS kind,
  CASE WHEN regexp_matches(n, '{predicates.CHAPTER}') OR {_MATTER} THEN 1 WHEN regexp_matches(n, '{predicates.SECTION}') THEN 2 ELSE coalesce({_DEPTH}, greatest(raw, 1)) END::INT AS level FROM {_BODY}"""


# --- headings of documents ------------------------------------------------------------------------

_MD = (
    "'---' || chr(10) || 'id: ' || id || chr(10) || '---' || chr(10) || repeat('#', least(greatest(coalesce(level, 1), 1), 4)) || ' ' || t || chr(10) || chr(10) || coalesce(text, '')"
    " || chr(10) || chr(10) || '**图 2-1 ' || t || '**' || chr(10) || '如图 2-1' || chr(10) || chr(10) || '***' || chr(10) || chr(10) || '### 眼 Eyes  of ' || coalesce(source_stem, '') || chr(10) || chr(10) || '看。'"
)
_DOCS = f"(SELECT id, {_MD} AS md FROM (SELECT *, coalesce(nullif(regexp_replace(heading_path[-1], '[^A-Za-z0-9一-鿿 ]', '', 'g'), ''), 'x') AS t FROM {_SECTIONS}))"
_BARE = r"regexp_replace(md, '^---\r?\n(?s:.*?)\r?\n---\r?\n?', '')"
_H = rf"^(#{{1,6}}){_BLANK}+(.*[^\s\x{{3000}}]){_BLANK}*$"
_FOUND = rf"list_transform(list_filter(string_split({_BARE}, {_NL}), lambda x: regexp_matches(x, '{_H}')), lambda x: struct_pack(level := length(regexp_extract(x, '{_H}', 1)), title := {_trim(f"regexp_extract(x, '{_H}', 2)")}))"


def _documents(spark: SparkSession, base: str) -> DataFrame:
    """``(id, md)``: each section as a small document with front matter, a figure's caption, a rule and a further heading."""
    title = F.coalesce(F.nullif(F.regexp_replace(F.try_element_at("heading_path", F.lit(-1)), "[^A-Za-z0-9一-鿿 ]", ""), F.lit("")), F.lit("x"))
    md = F.concat(
        F.lit("---\nid: "), "id", F.lit("\n---\n"), F.repeat(F.lit("#"), F.least(F.greatest(F.coalesce("level", F.lit(1)), F.lit(1)), F.lit(4))), F.lit(" "), title, F.lit("\n\n"), F.coalesce("text", F.lit("")),
        F.lit("\n\n**图 2-1 "), title, F.lit("**\n如图 2-1\n\n***\n\n### 眼 Eyes  of "), F.coalesce("source_stem", F.lit("")), F.lit("\n\n看。"),
    )
    return of_sections(spark, base, id="id", md=md)


@query(f"""SELECT id, list_aggregate(list_transform(f, lambda h: h.level::VARCHAR), 'string_agg', ',') AS levels, f[1].title AS first_title, len(list_filter(f, lambda h: h.level = 1))::BIGINT AS titles,
  coalesce(list_aggregate(list_transform(list_filter(f, lambda h: h.level >= 2), lambda h: repeat('  ', h.level - 2) || '- ' || h.title), 'string_agg', {_NL}), '') AS contents FROM (SELECT id, {_FOUND} AS f FROM {_DOCS})""")
def document_headings(spark: SparkSession, base: str) -> DataFrame:
    """The headings of a document: levels, the first, those of level 1, and the table of contents made of them."""
    md = F.col("md")
    return _documents(spark, base).select("id", F.array_join(T.heading_levels(md).cast("array<string>"), ",").alias("levels"), T.first_heading(md).alias("first_title"), T.count_h1(md).cast("bigint").alias("titles"), T.contents_list(T.headings(md)).alias("contents"))


_TARGET = "least(greatest(length(regexp_extract(x, '^(#{{1,6}})', 1)) + 3 - f[1].level, 1), 6)".replace("{{", "{").replace("}}", "}")


@query(rf"""SELECT id, sha256(list_aggregate(list_transform(string_split(md, {_NL}), lambda x: CASE WHEN regexp_matches(x, '^(#{{1,6}})({_BLANK}+.*)$') THEN repeat('#', {_TARGET}) || regexp_extract(x, '^(#{{1,6}})({_BLANK}+.*)$', 2) ELSE x END), 'string_agg', {_NL})) AS retargeted,
  sha256(regexp_replace({_BARE}, '^{_WS}*#{{1,6}}{_BLANK}+[^\n]*\n*', '')) AS beheaded, sha256({_trim(f"regexp_replace(list_aggregate(list_filter(string_split(md, {_NL}), lambda x: NOT regexp_matches(x, '^#{{1,6}}{_BLANK}+[^\\s]')), 'string_agg', {_NL}), '\\n{{3,}}', chr(10) || chr(10), 'g')")}) AS plain,
  sha256(list_aggregate(list_transform(string_split(md, {_NL}), lambda x: CASE WHEN regexp_matches(x, '^#{{1,6}}{_BLANK}+') AND regexp_matches(x, '{_HAN}') AND {_trim(rf"regexp_replace(regexp_replace(regexp_replace(x, '^#{{1,6}}{_BLANK}+', ''), '{_HAN}', '', 'g'), '\s{{2,}}', ' ', 'g')")} <> ''
    THEN regexp_extract(x, '^(#{{1,6}})', 1) || ' ' || {_trim(rf"regexp_replace(regexp_replace(regexp_replace(x, '^#{{1,6}}{_BLANK}+', ''), '{_HAN}', '', 'g'), '\s{{2,}}', ' ', 'g')")} ELSE x END), 'string_agg', {_NL})) AS latin FROM (SELECT id, md, {_FOUND} AS f FROM {_DOCS})""")
def headings_rewritten(spark: SparkSession, base: str) -> DataFrame:
    """Hashes of a document with its headings moved to level 3, without the first, without any, and without ideographs in them."""
    md = F.col("md")
    made = {"retargeted": T.retarget_headings(md, 3), "beheaded": T.without_leading_heading(T.without_front_matter(md)), "plain": T.without_inner_headings(md), "latin": T.without_han_in_headings(md)}
    return _documents(spark, base).select("id", *(F.sha2(c, 256).alias(n) for n, c in made.items()))


@query(rf"""SELECT id, len(p)::BIGINT AS parts, list_aggregate(list_transform(list_filter(p, lambda x: starts_with(x, '### ')), lambda x: regexp_extract(x, '^### {_BLANK}*([^\n]*?){_BLANK}*(?:\n|$)', 1)), 'string_agg', '|') AS titles, length({_trim("regexp_replace(p[-1], '^### [^\\n]*(?:\\n|$)', '')")})::BIGINT AS last_chars
  FROM (SELECT id, list_filter(list_transform(string_split({_NL} || {_BARE}, {_NL} || '### '), lambda x, i: CASE WHEN i = 1 THEN substr(x, 2) ELSE '### ' || x END), lambda x: {_trim('x')} <> '') AS p FROM {_DOCS})""")
def heading_parts(spark: SparkSession, base: str) -> DataFrame:
    """A document cut before its headings of level 3."""
    rows = _documents(spark, base).select("id", T.sections_at(F.col("md"), 3).alias("p"))
    return rows.select("id", F.size("p").cast("bigint").alias("parts"), F.array_join(F.transform("p", lambda x: x["title"]), "|").alias("titles"), F.length(F.element_at("p", -1)["body"]).cast("bigint").alias("last_chars"))


_CAPTION = rf"^{_WS}*(?:\*\*|__)?{_WS}*图{_WS}*\p{{Nd}}+(?:[.－—-]\p{{Nd}}+)?(?:{_WS}+.+?)?{_WS}*(?:\*\*|__)?{_WS}*$"
_NOTED = rf"list_transform(string_split(md, {_NL}), lambda x: CASE WHEN regexp_matches(x, '{_CAPTION}') AND NOT contains(x, '如图') THEN '*[Figure omitted from source conversion: ' || {_trim(f"regexp_replace({_trim('x')}, '^(?:\\*\\*|__)|(?:\\*\\*|__)$', '', 'g')")} || ']*' ELSE x END)"


@query(rf"""SELECT id, sha256(list_aggregate(n, 'string_agg', {_NL})) AS captions, sha256(regexp_replace(regexp_replace(list_aggregate(list_filter(n, lambda x: NOT regexp_matches(x, '{_RULE}')), 'string_agg', {_NL}), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\n+|\n+$', '', 'g')) AS cleaned,
  sha256(regexp_replace(list_aggregate(list_filter(string_split(md, {_NL}), lambda x: NOT regexp_matches(x, '{_RULE}')), 'string_agg', {_NL}), '^\n+|\n+$', '', 'g')) AS body FROM (SELECT id, md, {_NOTED} AS n FROM {_DOCS})""")
def figures_and_rules(spark: SparkSession, base: str) -> DataFrame:
    """Hashes of a document with captions as notes, without rules besides, and without rules only."""
    md = F.col("md")
    return _documents(spark, base).select("id", *(F.sha2(c, 256).alias(n) for n, c in (("captions", T.figure_captions(md)), ("cleaned", T.without_rules(md)), ("body", T.body_text(F.split(md, "\n"))))))


_QUOTED = r"""CASE WHEN t = '' OR regexp_matches(t, '[:#\[\]{},&*!|>''"%@`\\]|^[\s?-]|\s$') THEN '"' || replace(replace(t, '\', '\\'), '"', '\"') || '"' ELSE t END"""


@query(f"""SELECT t AS title, {_QUOTED} AS quoted, '---' || chr(10) || 'title: ' || {_QUOTED} || chr(10) || 'language: zh' || chr(10) || '---' AS front FROM {_TITLES} WHERE NOT regexp_matches(t, '[\\x{{80}}-\\x{{2fff}}\\x{{fe00}}-\\x{{10ffff}}]')""")
def front_matters(spark: SparkSession, base: str) -> DataFrame:
    """Titles quoted as YAML, and as front matter."""
    plain = _titles(spark, base).where(~F.col("t").rlike(r"[\x{80}-\x{2fff}\x{fe00}-\x{10ffff}]"))
    return plain.select(F.col("t").alias("title"), T.yaml_quoted(F.col("t")).alias("quoted"), assemble.front_matter({"title": F.col("t"), "language": F.lit("zh")}).alias("front"))


# --- counts and budgets ---------------------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN n % 2 = 0 THEN n ELSE floor(n * 0.9) END::BIGINT AS expected, n > 6000 OR ceil(CASE WHEN n % 2 = 0 THEN n ELSE floor(n * 0.9) END) + 256 > 8192 AS over, CASE WHEN lang = 'en' THEN 1.6 ELSE 1.1 END::DOUBLE AS factor,
  least(greatest(floor(n * 1.8) + 256, 1024), 8192)::BIGINT AS script FROM (SELECT doc_id, lang, length(text) AS n FROM documents WHERE text IS NOT NULL)""")
def stage_budgets(spark: SparkSession, base: str) -> DataFrame:
    """What a merge of each document would have to put out, whether that is too much, and the budgets of later stages."""
    n = F.col("n")
    rows = table(spark, base, "documents").where(F.col("text").isNotNull()).select("doc_id", F.length("text").alias("n"), F.when(F.col("lang") == "en", "translate-en").otherwise("translate-yue").alias("stage"))
    sized = rows.withColumn("expected", budget.expected_output(n * 0.9, n, n % 2 == 0))
    return sized.select("doc_id", "expected", budget.over_budget(n, F.col("expected"), 6000, 1.0).alias("over"), budget.expansion_factor(F.col("stage")).cast("double").alias("factor"), budget.script_tokens(n).cast("bigint").alias("script"))


@query(f"""SELECT doc_id, len(p)::BIGINT AS paragraphs, len(p[1:floor(len(p) / 3)::BIGINT])::BIGINT AS a, len(p[floor(len(p) / 3)::BIGINT + 1:floor(2 * len(p) / 3)::BIGINT])::BIGINT AS b, len(p[floor(2 * len(p) / 3)::BIGINT + 1:])::BIGINT AS c FROM (SELECT doc_id, {_PARAS} AS p FROM documents WHERE text IS NOT NULL)""")
def spread_paragraphs(spark: SparkSession, base: str) -> DataFrame:
    """Paragraphs spread evenly over three chapters."""
    rows = table(spark, base, "documents").where(F.col("text").isNotNull()).select("doc_id", T.paragraphs(F.col("text")).alias("p"))
    parts = T.spread(F.col("p"), F.lit(3))
    return rows.select("doc_id", F.size("p").cast("bigint").alias("paragraphs"), *(F.size(F.element_at(parts, i + 1)).cast("bigint").alias(c) for i, c in enumerate("abc")))


_SIMPLE = "[" + SIMPLIFIED_ONLY + "]"
_EVAL = r"regexp_replace(regexp_replace(text, '\[[^\]\n]+#[^\]\n]+\]', '', 'g'), '[A-Za-z]+', '', 'g')"
_N = "length({0}) - length(regexp_replace({0}, '{1}', '', 'g'))".format


@query(f"""SELECT doc_id, s IS NULL AND NOT (m > 3.0 * greatest(c, 1)) AND NOT (h > 0 AND c * 500 < h) AS passed,
  concat_ws('; ', CASE WHEN s IS NOT NULL THEN 'simplified: ' || s END, CASE WHEN m > 3.0 * greatest(c, 1) THEN 'particle ratio' END, CASE WHEN h > 0 AND c * 500 < h THEN 'particle density' END) AS reasons
  FROM (SELECT doc_id, list_aggregate(d[1:24], 'string_agg', '') AS s, m, c, h FROM (SELECT doc_id, {_N('b', '[的是不]')} AS m, {_N('b', '[嘅係唔]')} AS c, {_N('b', _HAN)} AS h, list_filter(l, lambda x, i: list_position(l, x) = i) AS d FROM (SELECT doc_id, b, regexp_extract_all(b, '{_SIMPLE}') AS l FROM
  (SELECT doc_id, {_EVAL} AS b FROM documents WHERE lower(lang) = 'yue' AND text IS NOT NULL))))""")
def cantonese_register(spark: SparkSession, base: str) -> DataFrame:
    """Whether each document in Cantonese passes as such, its script included, and why not."""
    rows = table(spark, base, "documents").where((F.lower("lang") == "yue") & F.col("text").isNotNull())
    verdict = T.cantonese_verdict(F.col("text"), SIMPLIFIED_ONLY)
    return rows.select("doc_id", verdict["passed"].alias("passed"), F.array_join(verdict["reasons"], "; ").alias("reasons"))


@query("SELECT doc_id, sha256(translate(text, '{}', '{}')) AS traditional FROM documents WHERE text IS NOT NULL".format(*TO_TRADITIONAL))
def traditional_texts(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "documents").where(F.col("text").isNotNull()).select("doc_id", F.sha2(T.script_converted(F.col("text"), *TO_TRADITIONAL), 256).alias("traditional"))


# --- groups of sections ---------------------------------------------------------------------------


@query(f"""SELECT id AS section_id, array_to_string(heading_path, '>') AS path, array_to_string(list_filter([{", ".join("CASE WHEN " + " OR ".join(f"contains(array_to_string(heading_path, ''), '{p}')" for p in ps) + f" THEN '{b}' END" for b, ps in inventory.LEXICON.items())}], lambda x: x IS NOT NULL), ',') AS keywords,
  CASE WHEN length(f) > 40 THEN substr(f, 1, 40) || '……' ELSE f END AS excerpt, char_count, kind, concat_ws('|', source_stem, array_to_string(heading_path, '>'), '', kind) AS line FROM (SELECT *, regexp_replace(text, '{_WS}+', '', 'g') AS f FROM {_SECTIONS} WHERE heading_path IS NOT NULL)""")
def inventory_rows(spark: SparkSession, base: str) -> DataFrame:
    """The inventory's row for each section, and the line by which its heading is listed."""
    rows = first_deliveries(table(spark, base, "sections"), "heading_path", "text", "char_count", "kind", "source_stem").where(F.col("heading_path").isNotNull())
    lines = rows.select(F.col("id").alias("lid"), inventory.heading_line(F.col("source_stem"), F.col("heading_path"), F.array(), F.col("kind")).alias("line"))
    made = inventory.heading_rows(rows, inventory.LEXICON).join(lines, F.col("section_id") == F.col("lid"))
    return made.select("section_id", F.array_join("heading_path", ">").alias("path"), F.array_join("keywords", ",").alias("keywords"), "excerpt", "char_count", "kind", "line")


_PATH_KEY = f"array_to_string(list_transform(coalesce(heading_path, []), lambda x: {_normal('x')}), '>')"


@query(f"""SELECT source_stem, heading_key, arg_min(id, struct_pack(a := -coalesce(char_count, 0), b := id)) AS canonical, count(*) AS members, sum(char_count)::BIGINT AS chars, sha256(string_agg('#### ' || coalesce(heading_path[-1], '') || '（' || source_stem || '）' || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY -coalesce(char_count, 0), id)) AS merged
  FROM (SELECT *, {_PATH_KEY} AS heading_key FROM {_SECTIONS} WHERE text IS NOT NULL AND source_stem IS NOT NULL) GROUP BY source_stem, heading_key""")
def heading_groups(spark: SparkSession, base: str) -> DataFrame:
    """The sections of a source under one heading: the longest, their sizes, and the fallback merge, longest first."""
    rows = first_deliveries(table(spark, base, "sections"), "source_stem", "heading_path", "char_count", "text").where(F.col("text").isNotNull() & F.col("source_stem").isNotNull()).withColumn("heading_path", F.coalesce("heading_path", F.array().cast("array<string>")))
    groups = merge.by_heading(rows.withColumn("node_id", F.col("source_stem")))
    joined = merge.concatenated(outline.heading_groups(rows), ["source_stem", "heading_key"])
    return groups.withColumnRenamed("node_id", "source_stem").join(joined, ["source_stem", "heading_key"]).select("source_stem", "heading_key", F.col("rank.id").alias("canonical"), "members", "chars", F.sha2("markdown", 256).alias("merged"))


@query(f"""SELECT source_stem, leaf_chars, round(o, 9) AS overlap, round(leaf_chars * (1 - o), 6) AS union_chars, round(leaf_chars * (1 - o) * 0.7, 6) AS size_floor FROM (SELECT source_stem, sum(char_count)::BIGINT AS leaf_chars FROM {_SECTIONS} WHERE source_stem IS NOT NULL GROUP BY source_stem)
  JOIN (SELECT s AS source_stem, coalesce(avg(j), 0.0) AS o FROM (SELECT DISTINCT source_stem AS s FROM sections WHERE source_stem IS NOT NULL) LEFT JOIN (SELECT source_stem AS s2, CASE WHEN level % 2 = 0 THEN 1.0 ELSE 0.5 END::DOUBLE AS j FROM {_SECTIONS} WHERE duplicate_of <> id) ON s = s2 GROUP BY s) USING (source_stem)""")
def union_sizes(spark: SparkSession, base: str) -> DataFrame:
    """Each source's size less its mean overlap, with the linked copies as pairs, and the least size of its merged text."""
    rows = of_sections(spark, base, id="id", source_stem="source_stem", char_count="char_count", duplicate_of="duplicate_of", level="level").where(F.col("source_stem").isNotNull())
    pairs = rows.where(F.col("duplicate_of") != F.col("id")).select("source_stem", F.when(F.col("level") % 2 == 0, 1.0).otherwise(0.5).alias("jaccard"))
    out = merge.union_metrics(rows, pairs, ["source_stem"])
    return out.select("source_stem", "leaf_chars", F.round("overlap", 9).alias("overlap"), F.round("union_chars", 6).alias("union_chars"), F.round("size_floor", 6).alias("size_floor"))


@query(f"""SELECT DISTINCT a.id FROM {_SECTIONS} a JOIN {_SECTIONS} b ON a.duplicate_of = b.id WHERE a.id <> b.id""")
def true_links(spark: SparkSession, base: str) -> DataFrame:
    """Sections that are marked as a duplicate of another one that exists."""
    rows = of_sections(spark, base, id="id", duplicate_of="duplicate_of")
    return merge.true_links(rows).where(F.col("duplicate_of").isNotNull()).select("id")


@query("""SELECT coalesce(a.pos, b.pos)::BIGINT AS pos, a.id AS left_id, b.id AS right_id, a.id IS NOT NULL AND b.id IS NOT NULL AS matched FROM (SELECT ord AS pos, id FROM sections WHERE level = 1) a FULL JOIN (SELECT ord - 1 AS pos, id FROM sections WHERE level = 2) b ON a.pos = b.pos""")
def aligned_parts(spark: SparkSession, base: str) -> DataFrame:
    """Headings of level 1 beside the ones of level 2 that follow them, by position."""
    rows = table(spark, base, "sections").withColumn("title", F.lit(""))
    left = rows.where("level = 1").select(F.col("ord").alias("pos"), "title", F.col("id").alias("body"))
    right = rows.where("level = 2").select((F.col("ord") - 1).alias("pos"), "title", F.col("id").alias("body"))
    return assemble.aligned(left, right).select("pos", F.col("body_a").alias("left_id"), F.col("body_b").alias("right_id"), "matched")


@query(f"""SELECT id, sha256(CASE WHEN regexp_matches({_trim('text')}, '^## Quizzes(?:\\n|$)') THEN {_trim('text')} ELSE '## Quizzes' || chr(10) || chr(10) || {_trim('text')} END) AS wrapped, sha256('---SOURCE ' || source_stem || '---' || chr(10) || text) AS block FROM {_SECTIONS} WHERE text IS NOT NULL AND source_stem IS NOT NULL""")
def wrapped_texts(spark: SparkSession, base: str) -> DataFrame:
    """Each text as an appendix, and as a source block of a merge request."""
    rows = of_sections(spark, base, id="id", wrapped=F.sha2(assemble.wrapped_appendix(F.col("text"), "Quizzes"), 256), block=F.sha2(merge.source_block(F.col("source_stem"), F.col("text")), 256))
    return rows.where(F.col("block").isNotNull())


# --- answers of a model ---------------------------------------------------------------------------

_ITEMS = "'[{\"section_id\":\"VARCHAR\",\"primary_node_id\":\"VARCHAR\",\"secondary_node_id\":\"VARCHAR\"}]'"
_ROWS = f"""(SELECT cache_key, unnest(a) AS a, unnest(range(len(a))) AS place FROM (SELECT cache_key, json_transform(response_text::JSON->'assignments', {_ITEMS}) AS a FROM (SELECT DISTINCT cache_key, response_text FROM llm_cache WHERE key.stage = 'assign') WHERE json_valid(response_text) AND json_array_length(response_text, '$.assignments') > 0)
  WHERE len(list_filter(a, lambda x: x.section_id IS NULL OR x.primary_node_id IS NULL)) = 0)"""


def _answers(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "llm_cache").where("key.stage = 'assign'").select("cache_key", "response_text").distinct()
    return rows.select("cache_key", F.posexplode(outline.parse_assignments(F.col("response_text"))).alias("place", "a")).select("cache_key", F.col("place").cast("bigint").alias("place"), "a.*")


@query(f"SELECT cache_key, place::BIGINT AS place, a.section_id AS section_id, a.primary_node_id AS primary_node_id, nullif(a.secondary_node_id, '') AS secondary_node_id FROM {_ROWS}")
def assignment_rows(spark: SparkSession, base: str) -> DataFrame:
    """Every assignment that a model has answered."""
    return _answers(spark, base)


@query(f"""WITH r AS (SELECT a.section_id AS s, a.primary_node_id AS p, nullif(a.secondary_node_id, '') AS q, cache_key || lpad(place::VARCHAR, 6, '0') AS o FROM {_ROWS}), l AS (SELECT s, arg_max(struct_pack(p := p, q := q), o) AS v FROM r GROUP BY s), k AS (SELECT DISTINCT p AS n FROM r WHERE p NOT LIKE '%0'),
  b AS (SELECT DISTINCT section_id AS s FROM (SELECT section_id FROM headings UNION ALL SELECT s FROM r) WHERE section_id IS NOT NULL) SELECT b.s AS section_id, coalesce(k1.n, 's-unknown') AS primary_node_id, k2.n AS secondary_node_id FROM b LEFT JOIN l USING (s) LEFT JOIN k k1 ON v.p = k1.n LEFT JOIN k k2 ON v.q = k2.n""")
def applied_assignments(spark: SparkSession, base: str) -> DataFrame:
    """Each heading with the last answer for it; nodes that are not known fall back."""
    rows = _answers(spark, base).withColumn("ord", F.concat("cache_key", F.lpad(F.col("place").cast("string"), 6, "0")))
    known = rows.select(F.col("primary_node_id").alias("node_id")).where(~F.col("node_id").like("%0")).distinct()
    batch = table(spark, base, "headings").select("section_id").unionAll(rows.select("section_id")).where(F.col("section_id").isNotNull()).distinct()
    return outline.applied_answers(batch, rows.select("section_id", "ord", "primary_node_id", "secondary_node_id"), known, "s-unknown")


@query(f"""SELECT node_id, string_agg(p, ',' ORDER BY o) AS primaries, count(*) AS refs, '另见：' || node_id || '（' || node_id || '）' AS zh, 'See also: ' || node_id || ' (' || node_id || ')' AS en FROM (SELECT nullif(a.secondary_node_id, '') AS node_id, a.primary_node_id AS p, cache_key || lpad(place::VARCHAR, 6, '0') AS o FROM {_ROWS}) WHERE node_id IS NOT NULL GROUP BY node_id""")
def cross_references(spark: SparkSession, base: str) -> DataFrame:
    """For each secondary node the primary ones that point to it, and its reference lines."""
    rows = _answers(spark, base).withColumn("ord", F.concat("cache_key", F.lpad(F.col("place").cast("string"), 6, "0")))
    node = F.col("node_id")
    line = lambda lang: assemble.cross_reference(lang, node, node, node, node)
    return outline.secondary_references(rows).select("node_id", F.array_join("primaries", ",").alias("primaries"), F.size("primaries").cast("bigint").alias("refs"), line("zh").alias("zh"), line("en").alias("en"))


_CLAIMS = "'[{\"id\":\"VARCHAR\",\"node_id\":\"VARCHAR\",\"claim_a\":{\"source\":\"VARCHAR\",\"text\":\"VARCHAR\"},\"claim_b\":{\"source\":\"VARCHAR\",\"text\":\"VARCHAR\"},\"equivalent_hint\":\"BOOLEAN\",\"inline_tag\":\"VARCHAR\"}]'"
_MERGES = f"""(SELECT cache_key, md, json_transform(tail::JSON, {_CLAIMS}) AS c FROM (SELECT cache_key, md, tail FROM (SELECT cache_key, CASE WHEN starts_with(r, '---CONFLICTS-JSON---' || chr(10)) THEN '' ELSE string_split(r, chr(10) || '---CONFLICTS-JSON---' || chr(10))[1] END AS md,
  regexp_replace(regexp_extract(r, '(?:^|\\n)---CONFLICTS-JSON---\\n((?s:.*))', 1), '^\\s+|\\s+$', '', 'g') AS tail FROM (SELECT DISTINCT cache_key, response_text AS r FROM llm_cache WHERE key.stage = 'merge') WHERE regexp_matches(r, '(?:^|\\n)---CONFLICTS-JSON---\\n'))
  WHERE starts_with(tail, '[') AND ends_with(tail, ']') AND json_valid(tail)))"""
PARSED_MERGES = f"""SELECT cache_key, length(md)::INT AS chars, len(c)::INT AS conflicts, len(list_filter(string_split({_BARE}, {_NL}), lambda x: regexp_matches(x, '{_H}')))::INT AS headings FROM {_MERGES} WHERE len(list_filter(c, lambda x: x.id IS NULL OR x.node_id IS NULL)) = 0"""


@query("""SELECT n_nationkey, 'c' || n_nationkey AS id, '### c' || n_nationkey || chr(10) || chr(10) || '- a：' || n_name || chr(10) || '- b：眼' || CASE WHEN n_nationkey % 2 = 0 THEN chr(10) || chr(10) || '[' || n_regionkey || ']' ELSE '' END AS block FROM nation WHERE n_nationkey % 5 <> 0""")
def conflict_rows(spark: SparkSession, base: str) -> DataFrame:
    """Conflicts parsed from answers made of the nations, each as a block of the appendix; answers with a fenced or an incomplete list give none."""
    claim = lambda source, text: F.struct(F.lit(source).alias("source"), text.alias("text"))
    conflict = F.struct(
        F.concat(F.lit("c"), "n_nationkey").alias("id"), F.lit("n").alias("node_id"), claim("a", F.col("n_name")).alias("claim_a"), claim("b", F.lit("眼")).alias("claim_b"), F.lit(False).alias("equivalent_hint"),
        F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("["), "n_regionkey", F.lit("]"))).otherwise("").alias("inline_tag"),
    )
    tail = F.when(F.col("n_nationkey") % 10 == 0, F.concat(F.lit("```json\n"), F.to_json(F.array(conflict)), F.lit("\n```"))).when(F.col("n_nationkey") % 5 == 0, F.lit('[{"id": "c"')).otherwise(F.to_json(F.array(conflict)))
    answers = table(spark, base, "nation").select("n_nationkey", F.concat("n_name", F.lit(f"\n{outline.TERMINATOR}\n"), tail).alias("text"))
    found = answers.select("n_nationkey", F.explode(outline.parse_merge_output(F.col("text"))["conflicts"]).alias("c")).select("n_nationkey", "c.*")
    return assemble.conflict_blocks(found).join(found.select("id", "n_nationkey"), "id")


@query("""SELECT cache_key AS call, sha256('{"input_hashes":["' || sha256(coalesce(user_text, '')) || '"],"model":"m","params":{"json_mode":false,"max_tokens":900,"temperature":0.2},"prompt_hash":"' || sha256('read {payload} of {stage}') || '","stage":"' || stage || '"}') AS request_key,
  sha256('read ' || coalesce(user_text, '') || ' of ' || stage) AS prompt FROM (SELECT DISTINCT cache_key, stage, user_text FROM llm_calls)""")
def request_keys(spark: SparkSession, base: str) -> DataFrame:
    """The key under which each call would be kept, and its filled template."""
    calls = table(spark, base, "llm_calls").select("cache_key", "stage", F.coalesce("user_text", F.lit("")).alias("user_text")).distinct()
    template = "read {payload} of {stage}"
    params = F.struct(F.lit(False).alias("json_mode"), F.lit(900).alias("max_tokens"), F.lit(0.2).alias("temperature"))
    key = cache_key(F.col("stage"), F.lit("m"), F.sha2(F.lit(template), 256), params, F.array(F.sha2("user_text", 256)))
    return calls.select(F.col("cache_key").alias("call"), key.alias("request_key"), F.sha2(filled(template, payload=F.col("user_text"), stage=F.col("stage")), 256).alias("prompt"))


@query("""SELECT r_regionkey, 'p' || r_regionkey || (SELECT coalesce(string_agg(',c' || n_nationkey || coalesce(ids, ''), '' ORDER BY n_nationkey), '') FROM nation LEFT JOIN (SELECT s_nationkey, string_agg(',s' || s_suppkey, '' ORDER BY s_suppkey) AS ids FROM supplier GROUP BY s_nationkey) ON s_nationkey = n_nationkey WHERE n_regionkey = r_regionkey) AS ids,
  coalesce((SELECT arg_min('s' || s_suppkey, struct_pack(a := n_nationkey, b := s_suppkey)) FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = r_regionkey AND n_nationkey = (SELECT min(n_nationkey) FROM nation WHERE n_regionkey = r_regionkey)), 'c' || (SELECT min(n_nationkey) FROM nation WHERE n_regionkey = r_regionkey)) AS first_leaf,
  (1 + (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) + (SELECT count(*) FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = r_regionkey))::BIGINT AS nodes,
  (SELECT sum(greatest(k, 1)) FROM (SELECT n_nationkey, count(s_suppkey) AS k FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey WHERE n_regionkey = r_regionkey GROUP BY n_nationkey))::BIGINT AS leaves FROM region""")
def outline_trees(spark: SparkSession, base: str) -> DataFrame:
    """Outlines parsed from JSON made of regions, nations and suppliers: their ids in order, the first leaf, nodes and leaves."""
    named = lambda kind, key: F.concat(F.lit(kind), key).alias("id")
    titles = F.lit("en").alias("title_en"), F.lit("题").alias("title_zh")
    in_order = lambda rows, key: F.transform(F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), F.col(rows).alias("v")))), lambda x: x["v"])
    leaf = table(spark, base, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey", F.struct(named("s", "s_suppkey"), *titles).alias("s"))
    leaves = leaf.groupBy("n_nationkey").agg(in_order("s", "s_suppkey").alias("sections"))
    chapter = table(spark, base, "nation").join(leaves, "n_nationkey", "left").select("n_regionkey", "n_nationkey", F.struct(named("c", "n_nationkey"), *titles, "sections").alias("c"))
    chapters = chapter.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(in_order("c", "n_nationkey").alias("chapters"))
    part = table(spark, base, "region").join(chapters, "r_regionkey", "left").select("r_regionkey", F.struct(named("p", "r_regionkey"), *titles, "chapters").alias("p"))
    texts = part.select("r_regionkey", F.to_json(F.struct(F.struct(F.lit("T").alias("en")).alias("title"), F.array("p").alias("parts"))).alias("text"))
    parsed = texts.select("r_regionkey", outline.parse_outline(F.col("text"))["parts"].alias("parts")).where(F.col("parts").isNotNull())
    flat = outline.nodes(parsed, "r_regionkey")
    sizes = flat.groupBy("r_regionkey").agg(F.count("*").alias("nodes")).join(outline.leaves(flat, "r_regionkey").groupBy("r_regionkey").agg(F.count("*").alias("leaves")), "r_regionkey")
    return parsed.select("r_regionkey", F.array_join(outline.ids(F.col("parts")), ",").alias("ids"), outline.first_leaf_id(F.col("parts")).alias("first_leaf")).join(sizes, "r_regionkey")


_NODES = ", ".join(f"('s-{b.replace('_', '-')}', '{b.replace('_', ' ').title()}', '{ps[0]}')" for b, ps in inventory.LEXICON.items())
_PATTERNS = ", ".join(f"('{b}', '{p}')" for b, ps in inventory.LEXICON.items() for p in ps)
PRESEEDED = f"""WITH f AS (SELECT * FROM (VALUES {_NODES}) v(node_id, en, zh)), x AS (SELECT * FROM (VALUES {_PATTERNS}) v(bucket, pattern)),
  m AS (SELECT bucket, min(node_id) AS node_id FROM (SELECT DISTINCT bucket, node_id FROM f JOIN x ON list_contains(string_split_regex(node_id, '[-_]'), bucket) OR list_contains(string_split(node_id, '-'), replace(bucket, '_', '')) OR regexp_matches(lower(en), '(?:^|[^\\pL\\pN_])' || replace(bucket, '_', ' ') || '(?:[^\\pL\\pN_]|$)') OR contains(zh, pattern) OR contains(lower(en), lower(pattern))) GROUP BY bucket HAVING count(*) = 1)
  SELECT id AS section_id, min(node_id) AS primary_node_id, NULL::VARCHAR AS secondary_node_id FROM (SELECT DISTINCT id, bucket FROM {_SECTIONS} JOIN x ON contains(array_to_string(heading_path, ''), pattern)) JOIN m USING (bucket) GROUP BY id HAVING min(node_id) = max(node_id)"""

_FACTS = r"regexp_replace(text, '([^\p{L}\p{N}_.])', '\1\1', 'g')"


def _sorted(x: str) -> str:
    return f"list_aggregate(list_sort(list_distinct(list_filter(list_transform({x}, lambda x: {_trim('x')}), lambda x: x <> ''))), 'string_agg', '|')"


@query(rf"""SELECT DISTINCT id, coalesce({_sorted(f"regexp_extract_all(text, '\\*\\*(.+?)\\*\\*', 1)")}, '') AS bold, coalesce({_sorted(rf"list_concat(regexp_extract_all(text, '[A-Z][A-Za-z]+(?:[ -][A-Z][A-Za-z]+)*'), list_concat(regexp_extract_all({_FACTS}, '(?:^|[^\p{{L}}\p{{N}}_])((?:METT|FACS|AU\p{{Nd}}+))(?:[^\p{{L}}\p{{N}}_]|$)', 1), list_transform(regexp_extract_all(text, '{_HAN}{{1,4}}·{_HAN}{{1,4}}'), lambda x: regexp_replace(x, '[提认说的在是了与和及]+$', ''))))")}, '') AS names,
  coalesce({_sorted(rf"list_concat(regexp_extract_all(text, '\p{{Nd}}+%'), list_concat(regexp_extract_all(text, '\p{{Nd}}+{_WS}*/{_WS}*\p{{Nd}}+'), list_concat(regexp_extract_all({_FACTS}, '(?:^|[^.\p{{Nd}}])(0\.\p{{Nd}}+)', 1), list_concat(regexp_extract_all(regexp_replace(text, '([^.\p{{Nd}}])', '\1\1', 'g'), '(?:^|[^.\p{{Nd}}])(\p{{Nd}}{{2,}})(?:[^.\p{{Nd}}]|$)', 1), regexp_extract_all(text, '\p{{Nd}}+(?:秒|分钟|小时|毫秒|次|种|个|条|项|章|节)')))))")}, '') AS numbers FROM {_SECTIONS} WHERE text IS NOT NULL AND NOT contains(text, 'Figure omitted')""")
def fact_families(spark: SparkSession, base: str) -> DataFrame:
    """The bold terms, names and numbers of each section, in the order of their characters."""
    from lectern.functions import coverage

    families = coverage.token_families(F.col("text"))
    rows = of_sections(spark, base, id="id", f=families, figure=F.contains("text", F.lit("Figure omitted"))).where("not figure")
    return rows.select("id", *(F.array_join(F.array_sort(f"f.{name}"), "|").alias(name) for name in ("bold", "names", "numbers")))


# --- relational operators -------------------------------------------------------------------------


@query("SELECT o_orderpriority, o_orderstatus, grouping(o_orderpriority)::INT AS g1, grouping(o_orderstatus)::INT AS g2, count(*) AS orders FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)")
def order_cube(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "orders").cube("o_orderpriority", "o_orderstatus").agg(F.grouping("o_orderpriority").cast("int").alias("g1"), F.grouping("o_orderstatus").cast("int").alias("g2"), F.count("*").alias("orders"))


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS orders FROM orders GROUP BY GROUPING SETS ((o_orderpriority), (o_orderstatus))")
def order_sets(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "orders")
    return rows.groupingSets([[F.col("o_orderpriority")], [F.col("o_orderstatus")]], F.col("o_orderpriority"), F.col("o_orderstatus")).agg(F.count("*").alias("orders"))


@query("SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 0 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 0")
def shared_nations(spark: SparkSession, base: str) -> DataFrame:
    customers = table(spark, base, "customer").where("c_acctbal > 0").select(F.col("c_nationkey").alias("nation"))
    return customers.intersect(table(spark, base, "supplier").where("s_acctbal > 0").select("s_nationkey"))


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000")
def modest_customers(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "customer").select("c_custkey").exceptAll(table(spark, base, "orders").where("o_totalprice > 300000").select("o_custkey")).distinct().join(
        table(spark, base, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey", "left_anti"
    )


@query("SELECT c_custkey, c_nationkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def urgent_customers(spark: SparkSession, base: str) -> DataFrame:
    urgent = table(spark, base, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, base, "customer").select("c_custkey", "c_nationkey").join(urgent, "c_custkey", "left_semi")


@query("SELECT w AS window_start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 1 HOUR, ts), time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR]) AS w FROM events) GROUP BY ALL")
def sliding_events(spark: SparkSession, base: str) -> DataFrame:
    """Events in windows of two hours that begin every hour."""
    rows = table(spark, base, "events").groupBy(F.window("ts", "2 hours", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return rows.select(F.col("w.start").alias("window_start"), "event_type", "n")


@query("SELECT event_type, a.source_stem AS stem, count(*) AS n FROM (SELECT DISTINCT source_stem, min(start_line) OVER (PARTITION BY source_stem) AS lo, max(end_line) OVER (PARTITION BY source_stem) AS hi FROM sections WHERE source_stem IS NOT NULL) a JOIN events e ON e.user_id BETWEEN a.lo AND a.hi GROUP BY ALL")
def events_in_ranges(spark: SparkSession, base: str) -> DataFrame:
    """Events whose user number lies between the first and last line of a source: a range join by buckets of 256 numbers, so that no pair is tried out of its reach."""
    bounds = of_sections(spark, base, id="id", stem="source_stem", a="start_line", b="end_line").where(F.col("stem").isNotNull()).groupBy("stem").agg(F.min("a").alias("lo"), F.max("b").alias("hi"))
    wide = bounds.select("*", F.explode(F.sequence(F.floor(F.col("lo") / 256), F.floor(F.col("hi") / 256))).alias("bucket"))
    events = table(spark, base, "events").select("event_type", "user_id", F.floor(F.col("user_id") / 256).alias("bucket"))
    return events.join(wide, "bucket").where(F.col("user_id").between(F.col("lo"), F.col("hi"))).groupBy("event_type", "stem").agg(F.count("*").alias("n"))


@query("SELECT event_id, event_type, last_value(CASE WHEN value > 100 THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_big, ntile(4) OVER (PARTITION BY event_type ORDER BY value, event_id)::INT AS quarter FROM events")
def latest_large_event(spark: SparkSession, base: str) -> DataFrame:
    """As of each event, the user's last large one, and the event's quarter by value within its type."""
    from pyspark.sql import Window

    seen = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    big = F.last(F.when(F.col("value") > 100, F.col("event_id")), ignorenulls=True).over(seen)
    return table(spark, base, "events").select("event_id", "event_type", big.alias("last_big"), F.ntile(4).over(Window.partitionBy("event_type").orderBy("value", "event_id")).alias("quarter"))


@query("SELECT year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, date_trunc('quarter', o_orderdate)::DATE AS q, max(date_diff('day', DATE '1992-01-01', o_orderdate::DATE))::INT AS days, count(*) AS n FROM orders GROUP BY ALL")
def order_dates(spark: SparkSession, base: str) -> DataFrame:
    at = F.col("o_orderdate")
    return table(spark, base, "orders").groupBy(F.year(at).alias("y"), F.month(at).alias("m"), F.trunc(at, "quarter").alias("q")).agg(F.max(F.datediff(at.cast("date"), F.lit("1992-01-01").cast("date"))).alias("days"), F.count("*").alias("n"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def formats_round_trip(spark: SparkSession, base: str) -> DataFrame:
    """The nations written and read again as ORC, CSV and JSON in turn."""
    import uuid

    from lectern.session import shared_dir

    rows = table(spark, base, "nation").select("n_nationkey", "n_name", "n_regionkey")
    schema = rows.schema
    for kind, options in (("orc", {}), ("csv", {"header": "true", "escape": '"'}), ("json", {})):
        path = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
        rows.write.format(kind).options(**options).save(path)
        rows = spark.read.schema(schema).format(kind).options(**options).load(path)
    return rows
