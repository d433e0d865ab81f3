import pytest
from pyspark.sql import functions as F

from lectern.functions import budget, coverage, predicates
from lectern.functions import text as T


@pytest.fixture(scope="module")
def value(spark):
    def of(column, **values):
        names = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items()) or "x int"
        return spark.createDataFrame([tuple(values.values()) or (1,)], names).select(column.alias("v")).first().v

    return of


def test_normal_forms(value):
    assert value(T.normalize_text(F.col("t")), t="**额肌_ ＡＢ**，左右 x_y") == "额肌AB左右xy"
    assert value(T.content_hash(F.col("t")), t="额肌，左右对称。") == value(T.content_hash(F.col("t")), t="额肌  左右对称")
    assert value(T.content_hash(F.col("t")), t="a_b") != value(T.content_hash(F.col("t")), t="ab")
    assert value(T.display_title(F.col("t")), t=" **第1章　眼   睛** ") == "第1章 眼 睛"
    assert value(T.compact_key(F.col("t"), True), t="目 录：A—b") == "目录ab"
    assert value(T.heading_path_key(F.col("p")), p=["*A*", "b  c"]) == "A>b c"
    assert value(T.heading_path_key(F.col("p"), False), p=["Ａ", "ｂ"]) == "A>b"
    assert value(T.normalize_text(F.col("t")), t=None) is None


def test_excerpt_and_lines(value):
    assert value(T.excerpt(F.col("t")), t="字　" * 41) == "字" * 40 + "……"
    assert value(T.excerpt(F.col("t")), t="字 \n" * 40) == "字" * 40
    assert value(T.visible_line(F.col("t")), t="- **返回总目录**") == "返回总目录"
    assert value(T.paragraphs(F.col("t")), t="a\n\n \nb\nc\n\n\n") == ["a", "b\nc"]
    assert value(T.figure_captions(F.col("t")), t="**图1.1　女商人**\n如图1.1\n图2") == "*[Figure omitted from source conversion: 图1.1　女商人]*\n如图1.1\n*[Figure omitted from source conversion: 图2]*"
    assert value(T.without_rules(F.col("t")), t="a\n---\n\n\n\nb") == "a\n\nb"


DOC = "---\ntitle: x\n---\n# A\n\n## 目录\n- B\n\n## B 眼\ntext\n\n### C\nmore\n#no\n"


def test_headings(value):
    assert [tuple(h) for h in value(T.headings(F.col("t")), t=DOC)] == [(1, "A"), (2, "目录"), (2, "B 眼"), (3, "C")]
    assert value(T.heading_levels(F.col("t"), 2), t=DOC) == [1, 2, 2]
    assert value(T.contents_list(T.headings(F.col("t"))), t=DOC) == "- 目录\n- B 眼\n  - C"
    assert value(T.retarget_headings(F.col("t"), 4), t="## a\n# b\n##### c\nx") == "#### a\n### b\n###### c\nx"
    assert value(T.retarget_headings(F.col("t"), 4), t="no heading") == "no heading"
    assert value(T.without_leading_heading(F.col("t")), t="\n## a\n\nb\n## c") == "b\n## c"
    assert value(T.without_han_in_headings(F.col("t")), t="## Eyes 眼睛 now\n## 眼\n眼") == "## Eyes now\n## 眼\n眼"
    assert [tuple(x) for x in value(T.sections_at(F.col("t"), 2), t=DOC)][1:] == [("目录", "- B"), ("B 眼", "text\n\n### C\nmore\n#no")]
    assert value(T.count_h1(F.col("t")), t=DOC) == 1
    assert value(T.first_heading(F.col("t")), t="x") is None


def test_counts(value):
    assert value(T.han_count(F.col("t")), t="a眼b睛") == 2
    assert value(T.word_count(F.col("t")), t="---\nq: 1\n---\na b　c") == 3
    assert value(T.han_density(F.col("t")), t="") == 0.0
    assert value(T.han_density(F.col("t")), t="ab（眼睛）眼d") == 0.25
    good = value(T.cantonese_verdict(F.col("t"), "说"), t="佢係唔係嘅" * 5)
    bad = value(T.cantonese_verdict(F.col("t"), "说"), t="他说的是不" * 5)
    assert good.passed and not bad.passed and bad.reasons[0] == "simplified: 说" and len(bad.reasons) == 3
    assert value(T.script_converted(F.col("t"), "说说们", "說X們", {"头发": "頭髮"}), t="他们说头发") == "他們說頭髮"


def test_cutting(value):
    assert value(T.hard_split(F.col("t"), 3), t="abcdefg") == ["abc", "def", "g"]
    assert value(T.hard_split(F.col("t"), 3), t="") == []
    assert value(T.packed_paragraphs(F.col("p"), 9), p=["aaa", "bbb", "cccccccccccc", "d", "e"]) == ["aaa\n\nbbb", "cccccccccccc", "d\n\ne"]
    assert value(T.overlapped_chunks(F.col("t"), 8), t="aaa\n\nbbb\n\nccc\n\ndddddddddd") == ["aaa\n\nbbb", "bbb\n\nccc", "dddddddddd"]
    assert value(T.spread(F.col("p"), F.lit(3)), p=list("abcde")) == [["a"], ["b", "c"], ["d", "e"]]
    assert value(T.yaml_quoted(F.col("t")), t='a: "b"') == '"a: \\"b\\""'
    assert value(T.yaml_quoted(F.col("t")), t="plain") == "plain"


def test_predicates(value):
    p = predicates
    for f, yes, no in (
        (p.is_contents_heading, "目 录", "目录学"), (p.is_preface_heading, "【序言】听", "尾声"), (p.is_bibliography_heading, "参考书目（一）", "书目"), (p.is_publisher_note, "出版说明", "说明"),
        (p.is_copyright_heading, "图书在版编目（CIP）数据", "版权故事"), (p.is_cover, "封面", "封面故事"), (p.is_afterword, "译者后记", "后来"), (p.is_chapter, "【第十二章】x", "第章"), (p.is_section, "第3节 x", "节"),
        (p.is_rule, " *** ", "**"), (p.returns_to_contents, "- 返回总目录", "返回"), (p.returns_to_contents_alone, "返回总目录", "- 返回总目录"), (p.is_metadata_line, "isbn 978", "书"), (p.is_sales_copy, "谈判高手", "高手"),
        (p.is_instructional, "“名言”，他说过", "他走了"), (p.is_imprint_text, "x CIP y", "CIPs"), (p.is_colophon, "责任印制：某", "某"), (p.has_choices, "A. x\nB. y\nC. z", "A. x B. y"), (p.is_magazine_quiz, "心理测试 你好吗", "心理测试"),
    ):
        assert value(f(F.col("t")), t=yes) is True, (f.__name__, yes)
        assert value(f(F.col("t")), t=no) is False, (f.__name__, no)
    level = lambda t, r: value(p.structural_level(F.col("t"), F.col("r")), t=t, r=r)
    assert [level("第一章", 3), level("第二节", 1), level("1.2.3 x", 1), level("1. x", 2), level("x", 0)] == [1, 2, 3, 2, 1]
    assert value(p.has_prose(F.col("p")), p=["字" * 40]) and not value(p.has_prose(F.col("p")), p=["- " + "字" * 50, "字" * 39])
    assert value(p.path_is_under(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("a")))) and not value(p.path_is_under(F.array(F.lit("a")), F.array(F.lit("a"))))


def test_facts(value):
    families = value(coverage.token_families(F.col("t")), t="1. 眉毛，\n**上扬** 姜振宇认为，保罗·艾克曼提出了 FACS 和AU12，0.04秒约10%的人，1/25，额肌")
    assert families.numbered == ["眉毛"] and families.bold == ["上扬"] and {"保罗·艾克曼", "FACS"} <= set(families.names)
    assert {"10%", "1/25", "0.04", "25"} <= set(families.numbers) and "额肌" in families.muscles
    sweat = value(coverage.token_families(F.col("t")), t="温热性出汗、精神性出汗、味觉性出汗和运动性出汗")
    assert sweat.numbered == ["温热性出汗", "精神性出汗", "味觉性出汗", "运动性出汗"]
    flat = value(coverage.flat_tokens(coverage.token_families(F.col("t"))), t="1、10.2\n2、索引\n3、ｘ")
    assert "10.2" not in flat and "索引" not in flat and "x" in flat
    missing = value(coverage.missing_tokens(F.col("t"), F.array(F.lit("說"), F.lit("眼")), ("说", "說")), t="他说")
    assert missing == ["眼"]


def test_budgets(value):
    b = budget
    assert value(b.estimate_tokens(F.lit(0), 1.5)) == 0 and value(b.estimate_tokens(F.lit(1), 1.5)) == 1
    assert value(b.needed_tokens(F.lit(100), 0.0)) == 356 and value(b.max_tokens(F.lit(100), 1.0, F.lit(4))) == 8192
    assert value(b.over_budget(F.lit(10), F.lit(9000), 100, 1.0)) and not value(b.over_budget(F.lit(10), F.lit(90), 100, 1.0))
    assert value(b.summary_tokens(F.lit(100))) == 256 and value(b.script_tokens(F.lit(10**6))) == 8192 and b.backoff_seconds(9) == 8.0


def test_muscles_and_numbered_items_begin_and_end_as_they_should(value):
    families = lambda t: value(coverage.token_families(F.col("t")), t=t)
    assert families("只由两块肌和令这两组肌发会造成肌肉紧张，颧大肌和眼轮匝肌除外。").muscles == ["颧大肌", "眼轮匝肌"]
    assert families("和咬肌收缩，与颧肌；将口轮匝肌").muscles == ["咬肌", "颧肌", "口轮匝肌"]
    eleven, twelve = "一二三四五六七八九十上", "一二三四五六七八九十上下"
    assert families(f"1. {eleven}。\n2. {twelve}。\n3. {twelve}").numbered == [eleven, twelve]


def test_imprints(value):
    for text in ("CIP数据核字（2010）", "ISBN 978\n责任印制：某", "图书在版编目"):
        assert value(predicates.is_imprint_text(F.col("t")), t=text) is True
    assert value(predicates.is_metadata_line(F.col("t")), t="图书在版编目（CIP）") is True
    assert value(predicates.is_imprint_text(F.col("t")), t="ISBN 978") is False
