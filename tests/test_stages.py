import json

import pytest
from pyspark.sql import functions as F

from lectern.operators import assemble, inventory, merge, outline


def test_lexicon_and_buckets(spark):
    lexicon = inventory.merged_lexicon({"eyes": ["睫毛", "眼"], "new": ["新"]})
    assert lexicon["eyes"][-1] == "睫毛" and list(lexicon)[-1] == "new" and lexicon["eyes"].count("眼") == 1
    assert inventory.lexicon_hash(lexicon) != inventory.lexicon_hash(inventory.LEXICON)
    rows = spark.createDataFrame([("a", ["握手时的眼睛"]), ("b", ["无"]), ("c", [])], "id string, heading_path array<string>")
    got = {r.id: (r.k, r.p) for r in rows.select("id", inventory.keywords(F.col("heading_path"), lexicon).alias("k"), inventory.primary_bucket(F.col("heading_path"), lexicon).alias("p")).collect()}
    assert got == {"a": (["eyes", "hands"], "eyes"), "b": ([], "other"), "c": ([], "other")}


def test_packing_equals_a_plain_loop(spark):
    sizes = [(i * 7919) % 90 + 1 for i in range(300)]
    rows = spark.createDataFrame([("g", i, "x" * n) for i, n in enumerate(sizes)], "g string, o int, line string")
    packs, total, want = 0, 0, []
    for n in sizes:
        t = max(1, int((n + 1) / 1.5))
        if total and total + t > 200:
            packs, total = packs + 1, 0
        total += t
        want.append(packs)
    got = [r.pack.pack for r in inventory.packed_headings(rows, "g", "o", "line", cap=200).orderBy("o").collect()]
    assert got == want


@pytest.fixture(scope="module")
def tree(spark):
    text = json.dumps({"title": {"en": "T"}, "extra": 1, "parts": [{"id": "p1", "title_en": "Eyes", "title_zh": "眼睛", "chapters": [{"id": "c1", "title_en": "Nose", "title_zh": "鼻", "sections": [{"id": "s-legs-1", "title_en": "L", "title_zh": "腿"}]}]}, {"id": "p2", "title_en": "Last", "title_zh": "尾", "chapters": []}]})
    return spark.createDataFrame([("t", text)], "k string, j string").select("k", outline.parse_outline(F.col("j")).alias("o"))


def test_outline_tree(spark, tree):
    flat = outline.nodes(tree.select("k", "o.parts"), "k").cache()
    assert [(r.level, r.node_id, r.parent_id) for r in flat.orderBy("ord").collect()] == [(1, "p1", None), (2, "c1", "p1"), (3, "s-legs-1", "c1"), (1, "p2", None)]
    assert {r.node_id for r in outline.leaves(flat, "k").collect()} == {"s-legs-1", "p2"}
    assert outline.counts(flat, "k").first()[1:] == (2, 1, 1)
    assert tree.select(outline.first_leaf_id(F.col("o.parts"))).first()[0] == "s-legs-1"
    bad = ['{"parts": []}', "no", '{"parts":[{"id":"a"},{"id":"a"}]}', '{"parts":[{"id":""}]}', None]
    assert spark.createDataFrame([(x,) for x in bad], "j string").select(outline.parse_outline(F.col("j")).alias("o")).where("o is not null").count() == 0


def test_preseed_and_answers(spark, tree):
    flat = outline.nodes(tree.select("k", "o.parts"), "k")
    matched = outline.bucket_nodes(flat, inventory.lexicon_rows(spark, inventory.LEXICON)).cache()
    assert {r.bucket: r.node_id for r in matched.collect()} == {"eyes": "p1", "nose": "c1", "legs": "s-legs-1"}
    heads = spark.createDataFrame([("h1", ["眼"]), ("h2", ["眼和鼻"]), ("h3", ["无"])], "section_id string, heading_path array<string>")
    assert [(r.section_id, r.primary_node_id) for r in outline.preseeded(heads, matched, inventory.LEXICON).collect()] == [("h1", "p1")]
    answers = spark.createDataFrame([("h2", 0, "c1", "p1"), ("h2", 1, "p2", "zz"), ("h3", 2, "zz", None)], "section_id string, ord int, primary_node_id string, secondary_node_id string")
    got = {r.section_id: (r.primary_node_id, r.secondary_node_id) for r in outline.applied_answers(heads, answers, flat, "s-x").collect()}
    assert got == {"h1": ("s-x", None), "h2": ("p2", None), "h3": ("s-x", None)}


def test_parsers(spark):
    rows = spark.createDataFrame([('[{"section_id":"a","primary_node_id":"n","secondary_node_id":""}]',), ('{"assignments":[]}',), ('{"assignments":[{"section_id":"a"}]}',), ("```json",)], "t string")
    got = [r.x for r in rows.select(outline.parse_assignments(F.col("t")).alias("x")).collect()]
    assert got[0][0].secondary_node_id is None and got[1:] == [None, None, None]
    conflict = '[{"id":"c","node_id":"n","claim_a":{"source":"s","text":"t"},"claim_b":{"source":"s","text":"t"},"equivalent_hint":true,"inline_tag":""}]'
    texts = [f"body\n---CONFLICTS-JSON---\n{conflict}", "body\n---CONFLICTS-JSON---\n[]", "body", "body\n---CONFLICTS-JSON---\n```[]```", "body\n---CONFLICTS-JSON---\n[{]"]
    got = [r.x for r in spark.createDataFrame([(t,) for t in texts], "t string").select(outline.parse_merge_output(F.col("t")).alias("x")).collect()]
    assert got[0].markdown == "body" and got[0].conflicts[0].equivalent_hint and got[1].conflicts == [] and got[2:] == [None, None, None]


def test_fallback_and_unique_ids(spark):
    heads = spark.createDataFrame([(1, ["眼", "b"]), (2, ["眼", "a"]), (3, []), (4, ["眼", "b"])], "ord int, heading_path array<string>")
    got = {(r.level, r.node_id, r.title_zh) for r in outline.fallback_outline(heads, inventory.LEXICON).collect()}
    assert {(3, "s-eyes-1-1", "b"), (3, "s-eyes-1-2", "a"), (2, "c-other-1", "body"), (1, "p-eyes", "eyes")} <= got
    flat = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a-2"), (4, "a"), (5, "b")], "o int, node_id string")
    assert [r.node_id for r in outline.unique_ids(flat, ["o"]).orderBy("o").collect()] == ["a", "a-3", "a-2", "a-4", "b"]
    refs = spark.createDataFrame([(1, "x", "n"), (2, "y", "n"), (3, "x", "n"), (4, "z", None)], "ord int, primary_node_id string, secondary_node_id string")
    assert outline.secondary_references(refs).collect()[0].primaries == ["x", "y", "x"]


def members(spark):
    same = "眼睛会说话" * 12
    return spark.createDataFrame(
        [("a", "n", same, 60, "h1", None, ["A"], "s1", "body"), ("b", "n", same, 60, "h1", "a", ["A"], "s2", "body"), ("c", "n", "短", 1, "h2", None, ["A"], "s3", "body"), ("d", "m", "字", 1, "h3", "zz", ["B"], "s4", "quiz")],
        "id string, node_id string, text string, char_count int, content_hash string, duplicate_of string, heading_path array<string>, source_stem string, kind string",
    )


def test_merge_groups(spark):
    rows = members(spark)
    assert {r.id for r in merge.unique_members(rows, ["node_id"]).collect()} == {"a", "c", "d"}
    pairs = {(r.a, r.b): r.jaccard for r in merge.group_pairs(rows, ["node_id"]).collect()}
    assert pairs == {("a", "b"): 1.0, ("a", "c"): 0.0, ("b", "c"): 0.0}
    metrics = {r.node_id: r for r in merge.union_metrics(rows, merge.group_pairs(rows, ["node_id"]), ["node_id"]).collect()}
    assert metrics["n"].union_chars == pytest.approx(121 * (1 - 1 / 3)) and metrics["m"].overlap == 0.0 and metrics["m"].size_floor == pytest.approx(0.7)
    assignments = spark.createDataFrame([("a", "n", 1), ("d", "n", 2), ("gone", "n", 3)], "section_id string, primary_node_id string, ord int")
    assert [r.id for r in merge.gathered(assignments, rows.drop("node_id")).collect()] == ["a"]
    assert merge.concatenated(rows.where("node_id = 'n' and id <> 'b'"), ["node_id"]).first().markdown.startswith("#### A（s1）\n\n眼睛")


def test_payload_faults_and_rates(spark):
    rows = [r.asDict() for r in members(spark).where("node_id = 'n'").collect()]
    whole = merge.payload(rows, 10000)
    cut = merge.payload([*rows, {**rows[0], "id": "e", "text": rows[0]["text"] + "\n\n全新的内容在这里", "source_stem": "s5", "char_count": 1}], 100)
    assert not whole[1] and whole[0].count("---SOURCE") == 3 and cut[1] and "UNIQUE FROM s5:\n全新的内容在这里" in cut[0] and "UNIQUE FROM s2" not in cut[0]
    faults = spark.createDataFrame([("综上所述 x", ["y"], 100.0), ("yz", ["y"], 1.0)], "t string, r array<string>, f double").select(merge.merge_faults(F.col("t"), F.col("r"), F.col("f")).alias("x")).collect()
    assert faults[0].x == ["missing: y", "smaller than the floor", "forbidden phrase"] and faults[1].x == []
    stats = spark.createDataFrame([(10.0, 5.0)] * 4 + [(0.0, 3.0)], "chars_out double, output_tokens double")
    assert merge.token_rate(stats).first()[:] == (1.0, 4) and merge.token_rate(stats.unionByName(stats)).first()[:] == (2.0, 8)
    meta = spark.createDataFrame([(1.0, 10.0, 0.1), (9.0, 10.0, 0.1), (2.0, 10.0, 0.2)], "out_chars double, union_chars double, overlap double")
    assert merge.canary(meta).first().failed


def test_assembly(spark, tree):
    flat = outline.nodes(tree.select("k", "o.parts"), "k")
    texts = spark.createDataFrame([("t", "s-legs-1", "### 腿\n正文")], "k string, node_id string, text string")
    refs = spark.createDataFrame([("t", "p2", "See")], "k string, node_id string, text string")
    body = assemble.document_body(flat, texts, refs, "k")
    assert body.first().body == "## 眼睛\n\n### 鼻\n\n#### 腿\n正文\n\n## 尾\n\nSee"
    whole = body.select(assemble.document(F.col("body"), F.lit("书"), "目录", assemble.front_matter({"title": F.lit("a: b")})).alias("d"))
    assert whole.first().d.startswith('---\ntitle: "a: b"\n---\n\n# 书\n\n## 目录\n\n- 眼睛\n  - 鼻\n    - 腿\n- 尾')
    assert whole.select(assemble.document_faults(F.col("d"), "zh", "目录").alias("x")).first().x == []
    assert whole.select(assemble.document_faults(F.col("d"), "en", "Contents").alias("x")).first().x == ["no contents after the title", "ideographs in headings", "too many ideographs"]
    sources = spark.createDataFrame([("b", 2, "h2"), ("a", 1, "h1"), ("a", 1, "h1")], "stem string, bytes int, sha256 string")
    assert assemble.source_table(sources).first().markdown.splitlines()[2:] == ["| a | 1 | h1 |", "| b | 2 | h2 |"]
    left = spark.createDataFrame([(0, "A", "x"), (1, "B", "y")], "pos int, title string, body string")
    assert [r.matched for r in assemble.aligned(left, left.where("pos = 0")).orderBy("pos").collect()] == [True, False]


def test_appendices(spark):
    rows = spark.createDataFrame([("q", "s1", "quiz", ["测试"], "题", 1), ("b", "s1", "bibliography", ["书目"], "见《甲》", 2)], "id string, source_stem string, kind string, heading_path array<string>, text string, start_line int")
    dropped = spark.createDataFrame([("《乙》和《甲》",)], "text string")
    sources = spark.createDataFrame([("a", 1, "h")], "stem string, bytes int, sha256 string")
    conflict = "id string, claim_a struct<source:string,text:string>, claim_b struct<source:string,text:string>, inline_tag string"
    clashes = spark.createDataFrame([("c1", ("s", "x"), ("t", "y"), "[c1]")], conflict)
    got = assemble.deterministic_appendices(rows, dropped, sources, clashes).cache()
    texts = {r.blob_id[:10]: r.text for r in got.collect()}
    assert texts["appendix-b"] == "### 测试\n\n题" and texts["appendix-d"] == "### c1\n\n- s：x\n- t：y\n\n[c1]" and "见《甲》" in texts["appendix-e"] and "- 《乙》" in texts["appendix-e"]
    assert [r.place for r in assemble.present_appendices(got).orderBy("place").collect()] == [0, 1, 3, 4]
    assert assemble.deterministic_appendices(rows.limit(0), dropped.limit(0), sources, clashes.limit(0)).count() == 1
    wrapped = got.where("blob_id like '%-b-%'").select(assemble.wrapped_appendix(F.col("text"), "测试").alias("w"))
    assert wrapped.select(assemble.wrapped_appendix(F.col("w"), "测试")).first() == wrapped.first()
