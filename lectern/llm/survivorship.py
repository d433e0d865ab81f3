"""Best representative of each duplicate group, chosen field by field.

One aggregation takes, for each attribute, the least composite struct of
(missing, negated priority, negated size, id, value); the value that rides in
the winning struct is the survivor's. No group is ever gathered in one task:
``min`` of a struct combines map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.components import connected_components

#: Spellings that stand for "not known" where a book's title should be, after trimming and lower-casing.
NO_BOOK = ("", "-", "--", "—", "——", "?", "？", "n/a", "na", "nil", "none", "null", "nan", "unknown", "untitled", "tbd", "无", "無", "未知", "不详", "不詳", "佚名", "未詳", "未详", "暂无", "暫無", "待定")

#: Spellings of "to be supplied", which are no book's name either.
TO_COME = ("待补", "待補", "待补充", "待補充")

#: Full-width ASCII, which NFKC would narrow, and the same narrowed.
WIDE, NARROW = "".join(map(chr, range(0xFF01, 0xFF5F))), "".join(map(chr, range(0x21, 0x7F)))

#: Brackets in which a stand-in may stand, once narrowed.
BRACKETS = r"()\[\]{}【】〔〕〖〗"

#: All of Unicode's white space, which trim() alone doesn't know.
SPACE = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def names_a_book(book: Column) -> Column:
    """True where the value is a title and not null, blank or a stand-in, whether or not the stand-in is in brackets or full-width."""
    outside = f"(?:{SPACE}|[{BRACKETS}])+"
    bare = F.lower(F.regexp_replace(F.translate(book, WIDE, NARROW), f"^{outside}|{outside}$", ""))
    return F.coalesce(~bare.isin(*NO_BOOK, *TO_COME), F.lit(False))


def survivors(sections: DataFrame, imprints: DataFrame) -> DataFrame:
    """``(group_id, survivor_id, source_book)`` for every group of two or more linked ids.

    Ids are linked by ``duplicate_of`` in either direction; links to the row
    itself, to absent ids and nulls join nothing. The survivor has the longest
    text (null counts as 0), then the smallest id. ``source_book`` comes from
    the member of the most trusted imprint (the part of ``source_stem`` before
    its first hyphen; no trust is below all others), then the longest text,
    then the smallest id, among members that name a book; null if none does.
    Repeated deliveries change nothing, as all aggregates are idempotent. Rows
    with a null id are left out. Extra columns are ignored.
    """
    ids = sections.where(F.col("id").isNotNull()).select("id").distinct()
    links = (
        sections.where(F.col("id") != F.col("duplicate_of")).select("id", "duplicate_of").distinct()
        .join(ids.withColumnRenamed("id", "duplicate_of"), "duplicate_of", "left_semi")
    )
    groups = connected_components(links, "id", "duplicate_of")
    trusted = imprints.groupBy("imprint").agg(F.max("trust").alias("trust"))
    members = (
        sections.select("id", F.length("text").alias("size"), F.substring_index("source_stem", "-", 1).alias("imprint"), "source_book")
        .join(groups.withColumnRenamed("node", "id"), "id")
        .join(trusted, "imprint", "left")
        .withColumn("size", -F.coalesce("size", F.lit(0)))
    )
    return (
        members.groupBy(F.col("component").alias("group_id"))
        .agg(
            F.min(F.struct("size", "id")).alias("best"),
            F.min(F.when(names_a_book(F.col("source_book")), F.struct(F.col("trust").isNull().alias("untrusted"), (-F.col("trust")).alias("trust"), "size", "id", "source_book"))).alias("book"),
        )
        .select("group_id", F.col("best.id").alias("survivor_id"), F.col("book.source_book").alias("source_book"))
    )
