"""All nine stages with a model that is a function."""

import json
import re

from lectern.__main__ import main, read_settings
from lectern.plans import pipeline
from lectern.plans.provider import FakeProvider
from lectern.plans.stages import Models, conflict_table, merged_groups, token_samples

CALLS = "calls.txt"


def answering(log):
    def answer(system, user):
        with open(log, "a") as out:
            out.write(system + "\n")
        if system == "merge":
            texts = re.split(r"---SOURCE [^\n]*---\n|UNIQUE FROM [^\n]*:\n", user)
            parts = [p.strip() for p in texts if p.strip()]
            clash = [{"id": f"x{len(parts)}", "node_id": "n", "claim_a": {"source": "a", "text": "1"}, "claim_b": {"source": "b", "text": "2"}, "equivalent_hint": False, "inline_tag": ""}]
            return "\n\n".join(dict.fromkeys(parts)) + "\n---CONFLICTS-JSON---\n" + json.dumps(clash)
        if system == "en":
            return re.sub("[一-鿿，。：（）]+", lambda m: "gaze" if m.group() else "", user)
        return "no json"

    return answer


def models_of(log):
    stages = {"outline": "outline", "assign": "assign", "merge": "merge", "translate-en": "en", "translate-yue": "yue"}
    return Models(FakeProvider(answering(log)), prompts={s: (name, "{payload}") for s, name in stages.items()})


BOOK_A = "# 瞳孔\n\n" + "瞳孔会随着光线与心情改变大小，观察的人应当先记下平日的样子。" * 3 + "\n\n# 握手\n\n" + "握手的力度说明对方的态度，不过也要看场合与习惯的差别。" * 3 + "\n"
BOOK_B = "# 瞳孔\n\n" + "瞳孔放大未必代表喜欢，也可能只是灯光变暗或者服药造成的。" * 3 + "\n\n# 眼睛\n\n" + "眼睛往哪里看，要与说话的内容一起判断，不能单独下结论。" * 3 + "\n"


def test_nine_stages_and_a_second_run_without_calls(spark, tmp_path):
    topic = tmp_path / "book" / "gaze"
    topic.mkdir(parents=True)
    (topic / "a.md").write_text(BOOK_A, encoding="utf-8")
    (topic / "b.md").write_text(BOOK_B, encoding="utf-8")
    log = tmp_path / CALLS
    args = ["gaze", "--books", str(tmp_path / "book"), "--out", str(tmp_path / "out"), "--last", "assemble", "--languages", "zh,en"]
    assert main(args, models_of(log)) == 0
    calls = log.read_text().splitlines()
    assert {"outline", "merge", "en"} <= set(calls)
    read = lambda name: spark.read.parquet(str(tmp_path / "out" / "gaze" / name))
    documents = {r.lang: r for r in read("documents").collect()}
    assert set(documents) == {"zh", "en"} and all(r.faults == [] for r in documents.values())
    assert "瞳孔会随着光线" in documents["zh"].text and "瞳孔放大未必" in documents["zh"].text and "## 目录" in documents["zh"].text and "## Contents" in documents["en"].text
    assert read("conflicts").count() == 1 and "分歧" in documents["zh"].text
    assert read("cache").count() == len(calls)
    # again: all answers are kept
    assert main(args, models_of(log)) == 0
    assert len(log.read_text().splitlines()) == len(calls)
    # one book changes: only it is cut again
    before = {r.stem: r.sha256 for r in read("extract").collect()}
    (topic / "b.md").write_text(BOOK_B + "\n# 新\n\n" + "新的一节，内容与前面不同，只为了看看是否会重新切分。" * 3, encoding="utf-8")
    assert main([*args[:5], "--last", "inventory"]) == 0
    after = {r.stem: r.sha256 for r in read("extract").collect()}
    assert after["a"] == before["a"] and after["b"] != before["b"] and read("sections").where("source_stem = 'b'").count() == 3


def test_settings_prompts_and_ranges(tmp_path, capsys):
    (tmp_path / ".env").write_text("# c\nexport LECTERN_X='y z'\nPATH=never\n")
    found = read_settings(str(tmp_path / ".env"))
    assert found["LECTERN_X"] == "y z" and found["PATH"] != "never"
    (tmp_path / "merge.md").write_text("---SYSTEM---\nbe brief\n---USER---\n{payload}\n")
    (tmp_path / "ex").mkdir()
    (tmp_path / "ex" / "merge.md").write_text("one\n")
    assert pipeline.read_prompts(str(tmp_path), str(tmp_path / "ex")) == {"merge": ("be brief\n\nEXAMPLES:\none", "{payload}")}
    assert main(["gaze", "--dry-run", "--first", "merge", "--last", "assemble"]) == 0
    assert capsys.readouterr().out.split() == ["merge", "translate-en", "translate-yue", "assemble"]
    assert main(["gaze", "--first", "assemble", "--last", "merge"]) == 2
    assert main(["../x"]) == 2


def test_large_groups_are_folded(spark, tmp_path):
    row = lambda i, text: (f"s{i}", "n", ["题"], f"b{i}", text, len(text), f"h{i}", None)
    texts = [f"第{i}本书这样说：" + "".join(chr(0x4E00 + i * 400 + k) for k in range(200)) + "。" for i in range(4)]
    members = spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], "id string, node_id string, heading_path array<string>, source_stem string, text string, char_count int, content_hash string, duplicate_of string")
    log = tmp_path / CALLS
    out = merged_groups(members, models_of(log), cap=500).collect()
    assert len(out) == 1 and out[0].status in ("merged", "concatenated") and all(t in out[0].markdown for t in texts)
    # the first two are one call; the rest follows
    assert len(log.read_text().splitlines()) >= 1
    assert conflict_table(spark.createDataFrame(out, merged_groups(members.limit(0), models_of(log)).schema)).count() >= 1 and len(token_samples(spark.createDataFrame(out, merged_groups(members.limit(0), models_of(log)).schema)).columns) == 2
