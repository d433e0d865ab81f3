"""Operators over documents and answers: tokens, mixing, answers, residue."""

import json
import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from lectern.llm import answers, mixing, residue, tokens

RANKS = tokens.ranks_of("byte_bpe_50k")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=RANKS, special_tokens={}).encode_ordinary


# --- tokens --------------------------------------------------------------------------------------------


def odd_texts():
    rng = random.Random(1)
    pools = [
        [chr(c) for c in range(1, 0x2FA20) if not 0xD800 <= c < 0xE000], [chr(c) for c in range(1, 0x250)], list(" \t\n\r\x85\xa0 　\x1c\x1f'sdtlvem.,a1"), list("の魔龍契士覚醒ドラゴン。，é·… "),
    ]
    return ["".join(rng.choices(pools[n % 4], k=rng.randint(1, 40))) for n in range(1200)] + ["<|endoftext|>", "a" * 3000, "眼" * 3000, " " * 500, "it's 'S I'LL", "👩‍🏫"]


def test_units_and_merges_are_exact(reference):
    cut, pattern = tokens.Units(RANKS), regex.compile(tokens.PATTERN)
    for text in odd_texts():
        assert [i for w in pattern.findall(text) for u in cut.of(w) for i in tokens.merge(u.encode(), RANKS)] == reference(text)


def test_fold_equals_merge(spark):
    units = ["a", "the", " hello", "眼", "の魔", "龍契士", "é", "…\"", "  ", "zzzzzzzz", "Pokémon", "'s", "​​", "αβγ"]
    rows = spark.createDataFrame([(u,) for u in units], "unit string").select("unit", tokens.fold_merges(F.col("unit"), RANKS).alias("ids"))
    assert {r.unit: r.ids for r in rows.collect()} == {u: tokens.merge(u.encode(), RANKS) for u in units}


def test_driver_keeps_no_ranks_in_descriptions(spark):
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    assert tokens.unit_ids(spark.createDataFrame([("plain words",)], "text string"), RANKS)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = store.executionsList()
    assert runs.size() > before
    for i in range(before, runs.size()):
        nodes = store.planGraph(runs.apply(i).executionId()).allNodes()
        assert all(len(nodes.apply(k).desc()) < 20_000 for k in range(nodes.size()))
    assert spark.conf.get("spark.sql.debug.maxToStringFields") == "25"


def test_encode_and_decode(spark, reference):
    texts = [None, "", *odd_texts()[::7], "<|endoftext|>", "句子。" * 20_000, "q" * 5000]
    df = spark.createDataFrame([(n, t, "x", "y", 3) for n, t in enumerate(texts)], "doc_id bigint, text string, ids string, unit string, n int")
    encoded = tokens.encode_texts(df).cache()
    got = {r.doc_id: r for r in encoded.collect()}
    assert set(got[0].asDict()) == {"doc_id", "ids", "unit", "n"} and encoded.schema["ids"].dataType.simpleString() == "array<int>"
    assert all(list(got[n].ids) == (reference(t) if t else []) for n, t in enumerate(texts))
    back = {r.doc_id: r.t for r in encoded.select("doc_id", tokens.decode_ids(F.col("ids")).alias("t")).collect()}
    assert all(back[n] == (t or "") for n, t in enumerate(texts))
    counts = {r.doc_id: r.tokens for r in tokens.encode_texts(df, count_only=True).collect()}
    assert all(counts[n] == len(got[n].ids) for n in counts)
    assert tokens.encode_texts(df.limit(0)).count() == 0
    few = tokens.unit_ids(df, RANKS, most=5)  # beyond the bound, units are merged where they are met
    assert len(few) == 5


# --- mixing ---------------------------------------------------------------------------------------------


def test_mixture_meets_budgets(spark):
    rng = random.Random(2)
    docs = [(n, s, "词" * rng.randint(0, 60), "x") for n, s in enumerate(["big"] * 300 + ["mid"] * 60 + ["tiny"] * 4 + ["zero"] * 9 + ["loose"] * 9 + [None] * 3)] + [(9000, "hollow", None, "x"), (9001, "hollow", "", "x")]
    targets = [("big", 0.5, 1.0), ("mid", 0.5, 3.0), ("tiny", 0.25, 2.0), ("zero", 0.0, 1.0), ("gone", 0.5, 1.0), ("hollow", 0.5, None), (None, 0.5, 1.0)]
    sizes = mixing.sized(spark.createDataFrame(docs, "doc_id bigint, source string, text string, part string")).cache()
    plan = mixing.plan_of(sizes, spark.createDataFrame(targets, "source string, weight double, max_repeats double")).cache()
    chosen = mixing.mix(sizes, plan).cache()
    report = {r.source: r for r in mixing.shares(plan, chosen).collect()}
    tokens_of = {r.doc_id: r.tokens for r in sizes.collect()}
    rows = chosen.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    assert set(report) == {"big", "mid", "tiny", "zero", "gone", "hollow", "loose", None}
    assert report["tiny"].reached_tokens == 2 * report["tiny"].available_tokens and report["tiny"].most_repeats == 2
    for source in ("big", "mid"):
        r, used = report[source], [x for x in rows if x.source == source]
        longest = max(tokens_of[n] for n, s, *_ in docs if s == source)
        assert r.target_tokens - longest < r.reached_tokens <= r.target_tokens and r.reached_tokens == sum(x.tokens * x.repeats for x in used)
    assert all(report[s].reached_tokens == 0 for s in ("zero", "gone", "hollow", "loose", None))
    assert sum(r.reached_share for r in report.values()) == pytest.approx(1.0) and sum(r.target_share for r in report.values()) == pytest.approx(1.0)
    small = mixing.plan_of(sizes, spark.createDataFrame(targets[:2], "source string, weight double, max_repeats double"), total=200)
    got = {r.source: r.reached_tokens for r in mixing.shares(small, mixing.mix(sizes, small)).collect()}
    assert 0 < got["big"] <= 100 and 0 < got["mid"] <= 100


def test_mixture_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("a", 1.0, 1.0)], "source string, weight double, max_repeats double")
    sizes = mixing.sized(empty)
    plan = mixing.plan_of(sizes, targets)
    assert mixing.mix(sizes, plan).count() == 0
    assert [(r.source, r.reached_tokens, r.reached_share) for r in mixing.shares(plan, mixing.mix(sizes, plan)).collect()] == [("a", 0, 0.0)]


# --- answers --------------------------------------------------------------------------------------------

PROMPT = "合并以下来源（节点 s-eyes-1）：\n\n观察陪审员时，最好请第三人复核；若手掌悄悄停顿超过1.13秒，可与平日的习惯比较。莫罗把这一现象称为“悲伤的视线”，并用279名译员的访谈稿加以说明。"
GOOD = "观察店员时，宜降低问题的压力。有人说“对不起，我不能说”，但手掌停顿了2.5秒。"
EN = "When the palm settles, it is not the same as anger; wait a few seconds before judging."
CASES = [
    (None, "zh", "empty"), ("", None, "empty"), ("​ 　\r\n", "zh", "empty"), ("```\n```", None, "empty"), ("# ", "zh", "empty"), ("**", "zh", "empty"), ("null", None, "empty"), ('""', None, "empty"), ("...", "en", "empty"), ("## 合并正文\n---CONFLICTS-JSON---\n[]", "zh", "empty"),
    (PROMPT, "zh", "copied"), (PROMPT.split("\n\n")[1], "zh", "copied"), ("以下为合并后的内容：\n\n" + PROMPT.split("\n\n")[1].replace("，", ", ").replace("。", " . "), "zh", "copied"), ("原文：" + PROMPT.split("\n\n")[1][:-8], "zh", "copied"),
    ("抱歉，我不能继续回答。如果您有别的问题，我很乐意帮忙。", "zh", "refusal"), ("I'm sorry, but I am unable to comply at this time.", "zh", "refusal"), ("唔好意思，我冇辦法答呢條問題呀，多謝體諒。", "yue", "refusal"), ('{"error": "对不起，恕我不便提供所请求的内容。"}', None, "refusal"),
    ("No translation will be given here - please consult a specialist.", "en", "refusal"), ("Je suis désolé, mais je ne peux pas vous aider.", "en", "refusal"),
    (GOOD + "若手掌悄", "zh", "truncated"), (GOOD + "计1.", "zh", "truncated"), (GOOD + "他说：“只停了一下。", "zh", "truncated"), (GOOD + "三点（其一。", "zh", "truncated"), ('{"assignments": [{"section_id": "x"}', None, "truncated"), ('```json\n{"a": 1}', None, "truncated"),
    (GOOD + "\n---CONFLICTS-JSON---\n[", "zh", "truncated"), (EN + "\n\n3.", "en", "truncated"), (EN + " The far", "en", "truncated"), (GOOD + "\n| a | b |\n|---|---|\n| c |  d", "zh", "truncated"),
    (EN, "zh", "other_language"), (GOOD, "en", "other_language"), ("佢講嘢嘅時候隱約停頓，但係心入面仲有啲憤怒未講出嚟。", "zh", "other_language"), (GOOD, "yue", "other_language"), ("相手の手首が何度も動いたときは、すぐに恥だと決めつけないでください。", "zh", "other_language"),
    ("On observe d'abord la voix, puis le poignet, sans jamais oublier le contexte.", "en", "other_language"), ("Nach ihm zeigten 8% der gefilmten Personen Verlegenheit, doch das beweist noch nichts.", "en", "other_language"),
    (GOOD, "zh", None), (GOOD, None, None), ("## 合并正文\n\n" + GOOD + "\n\n—— 整理自洛·维达", "zh", None), (EN + "\n\n*s-eyes-1*", "en", None), (EN + "\n\n[qinghe-000000#c1]", "en", None), (GOOD + "\n\n| 线索 | 次数 |\n|---|---|\n| 瞳孔 | 32 |", "zh", None), (GOOD + "\n\n🙂", "zh", None), (GOOD + "\n\n（完）", "zh", None),
    (GOOD + "\n---CONFLICTS-JSON---\n[]", "zh", None), ('```json\n{"a": []}\n```', None, None), (EN + "\n\nThe phrase “实习生为什么期待” is kept as printed.", "en", None), ("佢講嘢嘅時候隱約停頓，但係心入面仲有啲憤怒未講出嚟。", "yue", None), ("觀察店員時，宜降低問題的壓力。", "zh", None),
    (PROMPT.split("\n\n")[1][:40] + "。" + GOOD, "zh", None), ("- 手\n- 眼\n- 鼻", "zh", None), ("A) one is fine.\nB) two is fine.", "en", None),
]


def test_defects():
    wrong = [(text, lang, want, got) for text, lang, want in CASES if (got := answers.defect_of(text, PROMPT, lang)) != want]
    assert wrong == []
    assert answers.defect_of(GOOD * 5000, PROMPT, "zh") is None
    assert answers.defect_of(GOOD, None, "zh") is None


def test_defective_answers(spark):
    cache = spark.createDataFrame([("a", None, "stop", "x"), ("a", None, "stop", "x"), ("b", GOOD, "length", "x"), ("c", "抱歉，我不能回答。", None, "x"), ("d", EN, "stop", "x")], "cache_key string, response_text string, finish_reason string, defect string")
    calls = spark.createDataFrame([("a", PROMPT, "zh", "x"), ("b", PROMPT, "zh", "x"), ("c", None, None, "x"), ("e", PROMPT, "zh", "x")], "cache_key string, user_text string, reply_lang string, response_text string")
    found = answers.defective_answers(cache, calls)
    assert sorted(tuple(r) for r in found.collect()) == [("a", "empty"), ("c", "refusal")]
    assert answers.defective_answers(cache.limit(0), calls).count() == 0


def test_tiles():
    assert answers.tiles("xxabcdefyy", "abcdef", 3) == [(2, 0, 6)]
    assert answers.tiles("", "abc", 3) == [] and answers.tiles("abcabc", "abc", 3) == [(0, 0, 3)]


# --- residue ---------------------------------------------------------------------------------------------

PROSE = "观察店员时，宜降低问题的压力；若手掌悄悄停顿超过1.13秒，可与平日的习惯比较。有位乘客告诉莫·米黎，期限只剩一天。\n在展台旁，教练的手掌轻轻放松。"
RESIDUE = [
    ("placeholder", "亲爱的{{ userName }}，你好。" + PROSE), ("placeholder", PROSE + "<%= title %>"), ("placeholder", "Dear [INSERT name HERE], welcome."), ("placeholder", "【请填写：作者】"), ("placeholder", "a %%title%% b"), ("placeholder", "眉心__node_id__缓慢"), ("placeholder", "&lt;title&gt;"), ("placeholder", "｛price｝"), ("placeholder", "{summary}"), ("placeholder", "${x} #{y}"),
    ("filler", "Lorem ipsum praeva torque dolim lorem ubera calor nosti."), ("notice", "Sample text goes here. TBD. Your content here."), ("notice", "内容待补充。\n占位文本……\n请在此输入标题，"),
    ("notice", "404"), ("notice", "503 Service Unavailable"), ("notice", "到了讲台一侧，两侧瞳孔先短\n[object Object]"), ("notice", "错误 403：这篇文章加载失败，点击重新加载"), ("notice", "首頁 > 案例 > 眼\n會話已斷開，內容無法載入。\n本書禁止翻印"), ("notice", "Access denied; contact the site owner."), ("notice", "Please enable JavaScript to view this chapter.\nReading room, build 77"), ("notice", "本页依赖JS 与 Cookie加载正文。"), ("notice", "Home / the survey / the jaw\n\nUpstream request timeout\n(404)"),
    (None, PROSE), (None, ""), (None, None), (None, " \n "), (None, "集合{1,2,4}与{喜, 怒, 哀}[1]" + PROSE), (None, "看到“页面不存在”时，快递员右侧食指先后张开，图·林归为安心。\n" + PROSE), (None, "\"Access denied,\" joked a neighbour as the far thumb lifts.\nDelora met the witness in room 404 while the gait settles.\nShe wrote a timer in JavaScript to log how the jaw moves."),
    (None, "首页 > 眼\n" + PROSE), (None, "*[Figure omitted from source conversion: 图 5-2 左侧脚尖]*\n" + PROSE),
]


def test_residue(spark):
    docs = spark.createDataFrame([(n, t, "x", "y") for n, (_, t) in enumerate(RESIDUE)] + [(1000 + n, PROSE + str(n), "x", "y") for n in range(300)], "doc_id bigint, text string, kind string, term string")
    got = {r.doc_id: r.kind for r in residue.residue(docs).collect()}
    wrong = [(t, want, got.get(n)) for n, (want, t) in enumerate(RESIDUE) if got.get(n) != want]
    assert wrong == [] and not [n for n in got if n >= 1000]
    assert residue.without_residue(docs).count() == docs.count() - len(got)
    assert residue.residue(docs.limit(0)).count() == 0
    assert residue.residue(docs.where("doc_id < 0 or text is null")).count() == 0


def test_long_texts(spark):
    docs = spark.createDataFrame([(1, PROSE * 5000), (2, "404\n" * 5000)], "doc_id bigint, text string")
    assert {r.doc_id for r in residue.residue(docs).collect()} == {2}


def test_json_stays_valid():
    assert answers.is_truncated(json.dumps({"a": ["眼"]})) is False


def test_placeholders_have_no_length_cap():
    ex = residue.Exemplars()
    ex.weigh(np.ones(ex.size), 1.0)
    for size in (1, 60, 61, 5000):
        for text in ("正文{{%s}}后面" % ("a" * size), "x {%% include %s %%} y" % ("a" * size), "x <%%= %s %%> y" % ("a" * size), "dear ${%s}," % ("n" * size), "【请填写%s】" % ("字" * size)):
            assert residue.residue_kind(text, ex) == "placeholder", (size, text[:30])
    for text in ("{1, 2, 3}", "{{ open\n}}", "{% never closed " + "{% " * 5000, "<% " * 5000, "a [1] b", "f(x) = {x | x > 0}"):
        assert residue.residue_kind(text, ex) is None, text[:30]


def test_exemplars_are_a_parameter_and_phrases_unseen_are_found(spark):
    docs = spark.createDataFrame(
        [(1, "zorp glim the fleeb"), (2, "a hand on the table says that its owner is at rest"), (3, "脚本被禁用，本页無法显示。"), (4, "Chapter nine\nYou must sign in again to open this chapter"), (5, "她说：“页面不存在。”然后合上了书，望着窗外的雨，很久没有开口，直到茶凉了才起身离开房间。")],
        "doc_id bigint, text string",
    )
    assert {r.doc_id for r in residue.residue(docs, [("notice", "zorp glim"), ("filler", "fleeb")]).collect()} == {1}
    assert {r.doc_id for r in residue.residue(docs).collect()} == {3, 4}


def test_copies_with_slips_anywhere_are_copies():
    rng = random.Random(4)
    passage = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(400))
    for places in ((100, 200, 300), (120, 220, 320), (103, 203, 303)):
        slipped = "".join("呀" if n in places else c for n, c in enumerate(passage))
        assert answers.is_copied(slipped, "请翻译：\n" + passage)
    assert not answers.is_copied("".join(rng.sample(passage, 400)), "请翻译：\n" + passage)
    long_instruction = "请把下面的段落译成英文，保留所有数字与人名，不要添加任何解释。" * 5
    assert answers.is_copied(passage, long_instruction + "\n" + passage)


def test_tiles_take_the_longest_first():
    a = "abcdefghijklmno" + "pqrstuvwxyz0123456789"
    b = a[:15] + "#" + a[3:36]
    assert answers.tiles(a, b) == [(3, 16, 33)]  # what is left of the shorter stretch is too short for a tile
    rng = random.Random(5)
    for _ in range(200):
        x, y = ("".join(rng.choices("ab", k=rng.randint(0, 14))) for _ in range(2))
        assert answers.tiles(x, y, 2) == brute_tiles(x, y, 2)


def brute_tiles(a, b, least):
    out, in_a, in_b = [], set(), set()
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in in_a and j + n not in in_b:
                    n += 1
                if n >= least and (best is None or (-n, i, j) < best):
                    best = (-n, i, j)
        if best is None:
            return sorted(out)
        n, i, j = -best[0], best[1], best[2]
        out.append((i, j, n))
        in_a |= set(range(i, i + n))
        in_b |= set(range(j, j + n))
