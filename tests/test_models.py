import json

import pytest
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import inventory, outline
from lectern.plans import stages
from lectern.plans.provider import FakeProvider
from lectern.plans.stages import Models


def test_chunks(spark):
    one = lambda c, t: spark.createDataFrame([(t,)], "t string").select(c(F.col("t")).alias("v")).first().v
    assert one(lambda t: T.translation_chunks(t, 10), "#### a\nbb\n#### c\n\nddddddddddddd\n\ne") == ["#### a\nbb", "#### c", "dddddddddd", "ddd\n\ne"]
    assert one(T.script_chunks, "# T\n## A\ntext\n### B\nmore\n#### C\nx\n## D") == ["# T\n\n## A\ntext", "### B\nmore\n#### C\nx", "## D"]
    assert one(T.without_fences, "```markdown\nx\n```") == "x" and one(lambda t: T.translation_chunks(t, 5), "") == []


@pytest.fixture(scope="module")
def headings(spark):
    return spark.createDataFrame([("h1", 1, ["眼睛", "瞳孔"]), ("h2", 2, ["手", "握手"]), ("h3", 3, ["无题"])], "section_id string, ord int, heading_path array<string>")


def test_outline_falls_back_by_bucket(spark, headings):
    good = {"parts": [{"id": "p1", "title_en": "Eyes", "title_zh": "眼", "chapters": [{"id": "c1", "title_en": "Pupils", "title_zh": "瞳", "sections": []}]}]}
    models = Models(FakeProvider(lambda system, user: json.dumps(good) if "h1" in user else "no json"))
    rows = {(r.bucket, r.node_id) for r in stages.outlines(headings, inventory.LEXICON, models).collect()}
    assert {("eyes", "p1"), ("eyes", "c1"), ("hands", "p-hands"), ("other", "s-other-1-1")} <= rows and ("eyes", "p-eyes") not in rows
    assert models.cache.count() == 3


def test_assign_seeds_then_asks_then_halves(spark, headings):
    flat = spark.createDataFrame([("s-eyes-1", "Eyes", "眼"), ("s-b", "B", "乙")], "node_id string, title_en string, title_zh string")

    def answer(system, user):
        return "bad" if "\n" in user else json.dumps({"assignments": [{"section_id": user.split("|")[0], "primary_node_id": "s-b", "secondary_node_id": "zz"}]})

    got = {r.section_id: (r.primary_node_id, r.secondary_node_id) for r in stages.assignments(headings, flat, inventory.LEXICON, Models(FakeProvider(answer)), "s-f").collect()}
    assert got == {"h1": ("s-eyes-1", None), "h2": ("s-b", None), "h3": ("s-b", None)}
    silent = {r.section_id: r.primary_node_id for r in stages.assignments(headings, flat, inventory.LEXICON, Models(FakeProvider(lambda s, u: "")), "s-f").collect()}
    assert silent == {"h1": "s-eyes-1", "h2": "s-f", "h3": "s-f"}


def members(spark):
    rows = [("a", "n1", "0.04秒的微表情", 9, ["眼"], "s1"), ("b", "n1", "约10%的人能察觉", 9, ["眼"], "s2"), ("c", "n2", "独自一段", 4, ["手"], "s1"), ("d", "n3", "甲文" * 9, 18, ["嘴"], "s1"), ("e", "n3", "乙文" * 9, 18, ["嘴"], "s2")]
    return spark.createDataFrame([(*r, r[0], None) for r in rows], "id string, node_id string, text string, char_count int, heading_path array<string>, source_stem string, content_hash string, duplicate_of string")


def test_merge_checks_facts_and_asks_again(spark):
    def answer(system, user):
        if "甲文" in user:
            return "综上所述，" + "甲文乙文" * 20 + "\n---CONFLICTS-JSON---\n[]"
        return ("0.04秒的微表情，约10%的人能察觉" if "MISSING" in user else "0.04秒的微表情只有这些内容") + "\n---CONFLICTS-JSON---\n[]"

    models = Models(FakeProvider(answer))
    groups = stages.merged_groups(members(spark), models).cache()
    got = {r.node_id: (r.status, r.markdown) for r in groups.collect()}
    assert got["n1"] == ("merged", "0.04秒的微表情，约10%的人能察觉") and got["n2"] == ("single", "独自一段") and got["n3"] == ("failed", None)
    titles = spark.createDataFrame([("n1", "眼睛"), ("n3", "嘴")], "node_id string, title_zh string")
    nodes = {r.node_id: r for r in stages.node_texts(groups, titles).collect()}
    assert nodes["n1"].text.startswith("### 眼睛\n\n0.04秒") and nodes["n3"].status == "FAILED" and nodes["n3"].text is None and nodes["n2"].text == "### n2\n\n独自一段"
    plain = {r.node_id: r for r in stages.merged_groups(members(spark), Models(FakeProvider(lambda s, u: "no terminator"))).collect()}
    assert plain["n1"].status == "concatenated" and "#### 眼（s1）" in plain["n1"].markdown
    over = {r.node_id: r.faults for r in stages.merged_groups(members(spark), Models(FakeProvider(answer)), cap=20).collect()}
    assert over["n1"] == ["over budget"]


def test_translation_halves_what_is_cut_off(spark):
    class Short:
        def complete(self, system, user, temperature, max_tokens, json_mode):
            return (user.upper(), "stop", 1, 1) if len(user) <= 6 else ("cut", "length", 1, 1)

    texts = spark.createDataFrame([("n", "abcdefghij\n\nxyz"), ("m", "ok")], "node_id string, text string")
    got = {r.node_id: r.text for r in stages.translated(texts, "translate-en", Models(Short()), cap=12).collect()}
    assert got == {"n": "ABCDE\n\nFGHIJ\n\nXYZ", "m": "OK"}
    never = stages.translated(texts, "translate-yue", Models(FakeProvider(lambda s, u: "")), rounds=2).collect()
    assert {r.text for r in never} == {None}


def test_summaries_and_scripts(spark):
    models = Models(FakeProvider(lambda system, user: "S"))
    bodies = spark.createDataFrame([("short", "x" * 799), ("long", ("y" * 15_000 + "\n\n") * 2)], "key string, body string")
    assert {r.key: r.text for r in stages.summarized(bodies, models).collect()} == {"short": "x" * 799, "long": "S\n\nS"}
    assert models.cache.count() == 1  # equal chunks are asked for once
    docs = spark.createDataFrame([("d", "## A\nintro\n### B\n" + "z" * 900 + "\n### C\nshort")], "key string, text string")
    assert stages.tightened(docs, models).first().text == "## A\nintro\n\n### B\n\nS\n\n### C\n\nshort"
    assert stages.scripted(docs, Models(FakeProvider(lambda s, u: f"```text\n{len(u)}\n```"))).first().text.count("\n\n") == 2


def test_unknown_template_names_stay(spark):
    models = Models(FakeProvider(lambda system, user: system + user), prompts={"script": ("sys:", "[{payload}] {other}")})
    assert stages.scripted(spark.createDataFrame([("k", "body")], "key string, text string"), models).first().text == "sys:[body] {other}"
    assert outline.TERMINATOR == "---CONFLICTS-JSON---"
