"""Queries of the training-data operators over the project's tables."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import answers, canonical, lines, mixing, near, residue, spans, splitting, survivorship, tokens
from lectern.session import materialize, table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    return spans.shared_spans(table(spark, base, "sections"))


def p1_share(spark: SparkSession, base: str) -> DataFrame:
    """How much of each section is shared elsewhere."""
    sections = table(spark, base, "sections")
    return spans.shared_share(sections, spans.shared_spans(sections))


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    return lines.repeated_lines(table(spark, base, "sections"))


def p2_cleaned(spark: SparkSession, base: str) -> DataFrame:
    """Every section that loses lines, with the text that is left."""
    sections = table(spark, base, "sections")
    found = lines.repeated_lines(sections)
    touched = sections.select("id", "text").join(found.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"])
    return lines.remove_lines(touched, found)


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    return survivorship.survivors(table(spark, base, "sections"), table(spark, base, "imprints"))


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    return near.near_pairs(table(spark, base, "sections"))


def p4_classes(spark: SparkSession, base: str) -> DataFrame:
    """One row for each section with a near duplicate: its class of copies and the number of classes linked to it."""
    return near.near_members(table(spark, base, "sections"))


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    unusual = F.arrays_overlap("classes", F.array(*map(F.lit, canonical.UNUSUAL)))
    return canonical.uncommon_fields(table(spark, base, "sections")).where(unusual).select("id", "field").distinct()


def p5_canonical(spark: SparkSession, base: str) -> DataFrame:
    """The new values of the fields that were not in canonical form."""
    return canonical.uncommon_fields(table(spark, base, "sections")).dropDuplicates(["id", "field"])


def p6_found(spark: SparkSession, base: str) -> DataFrame:
    return answers.defective_answers(table(spark, base, "llm_cache"), table(spark, base, "llm_calls"))


def p7_found(spark: SparkSession, base: str) -> DataFrame:
    return splitting.split_oversized(table(spark, base, "sections")).where(F.col("piece_no") == 1).select("id").distinct()


def p7_pieces(spark: SparkSession, base: str) -> DataFrame:
    """The pieces of every section that had to be cut."""
    sections = table(spark, base, "sections").where(F.length("text") > splitting.LIMIT)
    return splitting.split_oversized(sections).dropDuplicates(["id", "piece_no"])


def p8_ids(spark: SparkSession, base: str) -> DataFrame:
    return tokens.encode_texts(table(spark, base, "documents").select("doc_id", "text"))


def p8_decoded(spark: SparkSession, base: str) -> DataFrame:
    """Every text, encoded and decoded again; a null text comes back empty."""
    encoded = p8_ids(spark, base)
    return encoded.select("doc_id", tokens.decode_ids(F.col("ids")).alias("text"))


def _mixture(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    sizes = mixing.sized(table(spark, base, "documents"))
    plan = mixing.plan_of(sizes, table(spark, base, "mix_targets"))
    return plan, materialize(mixing.mix(sizes, plan), "mixture")


def p9_shares(spark: SparkSession, base: str) -> DataFrame:
    return mixing.shares(*_mixture(spark, base))


def p9_mixture(spark: SparkSession, base: str) -> DataFrame:
    return _mixture(spark, base)[1]


def p10_found(spark: SparkSession, base: str) -> DataFrame:
    return residue.residue(table(spark, base, "documents")).select("doc_id").distinct()


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("p") and name[1:2].isdigit()}


_EMOJI = r"[\x{1F000}-\x{1FAFF}\x{FE0F}\x{2600}-\x{27BF}]"
_UNUSUAL = (
    r"[\x{FF10}-\x{FF19}\x{FF21}-\x{FF3A}\x{FF41}-\x{FF5A}\x{300}-\x{36F}\x{20D0}-\x{20DC}\x{AD}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{FEFF}\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}"
    r"\x{2E80}-\x{2FD5}\x{F900}-\x{FA0D}\x{FA30}-\x{FAD9}]|[A-Za-z\x{C0}-\x{24F}][\x{370}-\x{3FF}\x{400}-\x{52F}]|[\x{370}-\x{3FF}\x{400}-\x{52F}][A-Za-z\x{C0}-\x{24F}]"
)
#: What the letters and digits of a stand-in say; written for the SQL alone, apart from the operator's list.
_UNNAMED = "'', 'na', 'nil', 'none', 'null', 'nan', 'unknown', 'untitled', 'tbd', '无', '無', '未知', '不详', '不詳', '未详', '未詳', '佚名', '暂无', '暫無', '待定', '待补', '待補', '待补充', '待補充'"


def _nfkc(x: str) -> str:
    """NFKC in SQL, by a rule: characters that become one other by translation, the ellipsis and composition besides."""
    single = {}
    for code in (*range(0xA0, 0x3400), *range(0xF900, 0x10000)):
        new = unicodedata.normalize("NFKC", chr(code))
        if new != chr(code) and len(new) == 1 and new != "'":
            single[chr(code)] = new
    return f"nfc_normalize(replace(translate({x}, '{''.join(single)}', '{''.join(single.values())}'), '…', '...'))"


_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _unjoined(column: str) -> str:
    """Joiners between emoji taken out; twice, as matches can't overlap."""
    once = f"regexp_replace({column}, '({_EMOJI})\\x{{200D}}({_EMOJI})', '\\1\\2', 'g')"
    return f"regexp_replace({once}, '({_EMOJI})\\x{{200D}}({_EMOJI})', '\\1\\2', 'g')"


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can express: it has no NFKC, tokenizer or parser."""
    return {
        "p1_found": """WITH t AS (SELECT DISTINCT id, text FROM sections WHERE length(text) >= 80), g AS (SELECT id, unnest(range(0, length(text) - 79)) AS i, text FROM t), h AS (SELECT id, i, substr(text, i + 1, 80) AS gram FROM g),
            r AS (SELECT gram FROM h GROUP BY gram HAVING min(id) <> max(id)), s AS (SELECT id, i, i - lag(i) OVER (PARTITION BY id ORDER BY i) AS step FROM h SEMI JOIN r USING (gram)),
            k AS (SELECT id, i, sum(CASE WHEN step <= 80 THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY i) AS run FROM s) SELECT id, min(i)::BIGINT AS span_start, (max(i) + 80)::BIGINT AS span_end FROM k GROUP BY id, run""",
        "p2_found": f"""WITH s AS (SELECT DISTINCT id, source_stem, string_split(text, chr(10)) AS l FROM sections WHERE text IS NOT NULL), r AS (SELECT id, source_stem, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS line_no FROM s),
            f AS (SELECT id, source_stem, line_no, regexp_replace(trim(regexp_replace({_nfkc('line')}, '{_SPACE}+', ' ', 'g')), '[0-9]+', '0', 'g') AS form FROM r), k AS (SELECT source_stem, form FROM f WHERE form <> '' GROUP BY ALL HAVING count(DISTINCT id) >= 8)
            SELECT DISTINCT id, line_no FROM f SEMI JOIN k USING (source_stem, form)""",
        "p4_found": f"""WITH t AS (SELECT DISTINCT id, regexp_replace({_nfkc('text')}, '[^\\p{{L}}\\p{{N}}]', '', 'g') AS x FROM sections WHERE text IS NOT NULL), g AS (SELECT id, unnest(list_distinct(list_transform(range(1, length(x) - 3), lambda i: substr(x, i, 5)))) AS g FROM t WHERE length(x) >= 40),
            n AS (SELECT id, count(*) AS n FROM g GROUP BY id), h AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS k FROM g a JOIN g b ON a.g = b.g AND a.id < b.id GROUP BY ALL)
            SELECT id_a, id_b FROM h JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b WHERE k >= 0.55 * (x.n + y.n - k)""",
        "p3_found": f"""WITH RECURSIVE s AS (SELECT id, any_value(text) AS text, any_value(source_stem) AS stem, any_value(source_book) AS book, any_value(duplicate_of) AS dup FROM sections GROUP BY id),
            e AS (SELECT a.id AS x, a.dup AS y FROM s a SEMI JOIN s b ON a.dup = b.id WHERE a.id <> a.dup), u AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
            r AS (SELECT x AS node, x AS seen FROM u UNION SELECT r.node, u.y FROM r JOIN u ON r.seen = u.x), g AS (SELECT node AS id, min(seen) AS group_id FROM r GROUP BY node),
            m AS (SELECT g.group_id, s.id, coalesce(length(text), 0) AS size, trust, CASE WHEN lower(regexp_replace(book, '[^\\pL\\pN]', '', 'g')) IN ({_UNNAMED}) THEN NULL ELSE book END AS book FROM g JOIN s USING (id) LEFT JOIN imprints ON imprint = string_split(stem, '-')[1])
            SELECT a.group_id, a.id AS survivor_id, b.book AS source_book FROM (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY size DESC, id) = 1) a
            LEFT JOIN (SELECT * FROM m WHERE book IS NOT NULL QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY trust DESC NULLS LAST, size DESC, id) = 1) b ON a.group_id = b.group_id""",
        "p5_found": f"""SELECT DISTINCT id, 'text' AS field FROM sections WHERE regexp_matches({_unjoined('text')}, '{_UNUSUAL}') OR contains({_unjoined('text')}, chr(8205))
            UNION SELECT DISTINCT id, 'heading_path' FROM (SELECT id, unnest(heading_path) AS part FROM sections) WHERE regexp_matches({_unjoined('part')}, '{_UNUSUAL}') OR contains({_unjoined('part')}, chr(8205))""",
        "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
        "p7_found": "SELECT DISTINCT id FROM sections WHERE length(text) > 4000",
    }
