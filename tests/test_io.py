import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from lectern.plans import pipeline
from lectern.plans.provider import FakeProvider, HttpProvider, cache_key, compacted, completed, filled, record_of, redacted, template_sections
from lectern.session import materialize, shared_dir
from lectern.sources import books
from lectern.streaming.ingest import ingested, sessions, windowed_counts


def test_books(spark, tmp_path):
    topic = tmp_path / "face"
    topic.mkdir()
    for name, text in {"a.md": "# A\n正文\n", "b.md": "b", ".hidden.md": "x", "face.md": "x", "face.hk.md": "x", "c.zh.md": "x", "compiled-1.md": "x", "d.epub": "x"}.items():
        (topic / name).write_text(text, encoding="utf-8")
    (topic / "sub").mkdir()
    (topic / "sub" / "e.md").write_text("x")
    found = books.required(books.books(spark, str(tmp_path), "face")).orderBy("stem").collect()
    assert [(r.stem, r.bytes, r.chars, r.physical_lines) for r in found] == [("a", 11, 7, 2), ("b", 1, 1, 1)]
    for bad in ("../x", "", "a/b", "-x"):
        with pytest.raises(books.NoSources):
            books.valid_topic(bad)
    old = spark.createDataFrame([("a", found[0].sha256, "1")], "stem string, sha256 string, version string")
    now = books.books(spark, str(tmp_path), "face")
    assert [r.stem for r in books.changed_only(now, old, "1").collect()] == ["b"] and books.changed_only(now, old, "2").count() == 2


def test_pipeline_and_publish(spark, tmp_path):
    topic = tmp_path / "in" / "t"
    topic.mkdir(parents=True)
    body = "".join(chr(0x4E00 + i) for i in range(300))
    (topic / "x.md").write_text(f"# 眼睛\n{body}\n# 手\n别的", encoding="utf-8")
    (topic / "y.md").write_text(f"# 瞳孔\n{body}多\n", encoding="utf-8")
    out = pipeline.build(spark, str(tmp_path / "in"), "t", str(tmp_path / "out"))
    assert {(r.id, r.duplicate_of) for r in out.sections.collect()} == {("x:1:2", "y:1:2"), ("x:3:4", None), ("y:1:2", None)}
    assert out.headings.where("array_contains(keywords, 'eyes')").count() == 2
    books.publish(spark.range(3), str(tmp_path / "out" / "sources"))
    assert spark.read.parquet(str(tmp_path / "out" / "sources")).count() == 3
    assert not [p for p in (tmp_path / "out").iterdir() if "partial" in p.name or "old" in p.name]
    assert pipeline.stages_between("merge", "assemble") == ("merge", "translate-en", "translate-yue", "assemble")
    books.publish_texts({"a.md": "x\n"}, str(tmp_path / "docs"))
    assert (tmp_path / "docs" / "a.md").read_bytes() == b"x\n"


def test_conflicts_skip_bad_lines(spark, tmp_path):
    path = tmp_path / "c.jsonl"
    path.write_text('{"id":"a","node_id":"n","equivalent_hint":true}\n\nnot json\n', encoding="utf-8")
    assert [r.id for r in books.read_conflicts(spark, str(path)).collect()] == ["a"]


def test_appended_rows(spark, tmp_path):
    path = str(tmp_path / "stats")
    books.append_rows(spark.createDataFrame([(10, 5)], "chars_out int, output_tokens int"), path)
    books.append_rows(spark.createDataFrame([(20, 5)], "chars_out int, output_tokens int"), path)
    assert sorted(r.chars_out for r in books.read_token_stats(spark, path).collect()) == [10.0, 20.0]
    books.reset_rows(spark.createDataFrame([(1, 1)], "chars_out int, output_tokens int"), path)
    assert books.read_token_stats(spark, path).count() == 1


def test_command_line(tmp_path, capsys):
    from lectern.__main__ import main

    assert main(["../bad", "--books", str(tmp_path), "--out", str(tmp_path / "o")]) == 2
    assert main(["topic", "--books", str(tmp_path), "--out", str(tmp_path / "o"), "--dry-run"]) == 0
    assert capsys.readouterr().out.split() == ["discover", "extract", "inventory"]


def test_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert materialize(spark.range(5).selectExpr("id", "map('a', id) m")).count() == 5


def requests(spark):
    rows = [("k1", "", "one", 0.2, 100, False), ("k2", "", "two", 0.2, 100, False), ("k2", "", "two", 0.2, 100, False)]
    return spark.createDataFrame(rows, "cache_key string, system string, user_text string, temperature double, max_tokens int, json_mode boolean")


def test_cache_is_read_first(spark):
    cache = spark.createDataFrame([("k1", "old", "stop", 1, 1), ("k1", "old", "stop", 1, 1)], "cache_key string, response_text string, finish_reason string, input_tokens int, output_tokens int")
    fake = FakeProvider(lambda system, user: user.upper())
    answers, new = completed(requests(spark), cache, fake)
    assert sorted((r.cache_key, r.response_text) for r in answers.collect()) == [("k1", "old"), ("k2", "TWO"), ("k2", "TWO")] and [r.cache_key for r in new.collect()] == ["k2"]
    answers, new = completed(requests(spark), cache, fake, force=True)
    assert {r.response_text for r in answers.collect()} == {"ONE", "TWO"} and new.count() == 2


def test_keys_and_compaction(spark):
    row = spark.sql("select cache_key_input.* from (select named_struct('s','merge','m','g','p','h','h', array('b','a')) cache_key_input)")
    params = F.struct(F.lit(False).alias("json_mode"), F.lit(0.2).alias("temperature"))
    got = row.select(cache_key(F.col("s"), F.col("m"), F.col("p"), params, F.col("h")).alias("k")).first().k
    import hashlib

    want = json.dumps({"input_hashes": ["a", "b"], "model": "g", "params": {"json_mode": False, "temperature": 0.2}, "prompt_hash": "h", "stage": "merge"}, sort_keys=True, separators=(",", ":"))
    assert got == hashlib.sha256(want.encode()).hexdigest()
    cache = spark.createDataFrame([("k", "new", "2024-05-02T00:00:00Z"), ("k", "old", "2024-05-01"), ("z", None, "bad")], "cache_key string, response_text string, created_at string")
    assert sorted((r.cache_key, r.response_text) for r in compacted(cache).collect()) == [("k", "new"), ("z", None)]
    assert row.select(filled("{m}-{x}", m=F.col("m")).alias("t")).first().t == "g-{x}"
    assert template_sections("x\n---SYSTEM---\na\n---USER---\nb\nc\n---SYSTEM---\nd") == {"SYSTEM": "d", "USER": "b\nc"}
    assert "secret" not in redacted("key secret Bearer abc " + "x" * 500, "secret") and "abc" not in redacted("Bearer abc", "")
    assert "sk-1" not in repr(HttpProvider("http://h", "m", "sk-1"))
    with pytest.raises(RuntimeError):
        record_of({"choices": []})


def test_http_provider_tries_again():
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            code = (429, 200, 400)[len(seen) - 1]
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps({"choices": [{"message": {"content": "hi"}}], "usage": {"prompt_tokens": 3}}).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    provider = HttpProvider(f"http://127.0.0.1:{server.server_port}", "m", "key")
    assert provider.complete("s", "u", 0.2, 10, True) == ("hi", "stop", 3, 0)
    assert seen[0]["response_format"] == {"type": "json_object"} and seen[0]["messages"][0]["role"] == "system"
    with pytest.raises(RuntimeError):
        provider.complete("", "u", 0.2, 10, False)
    server.shutdown()


def test_streams(spark, tmp_path):
    spark.createDataFrame([("s", "# A\nx\n# B\ny")], "stem string, text string").write.parquet(str(tmp_path / "in"))
    docs = spark.readStream.schema("stem string, text string").parquet(str(tmp_path / "in"))
    for _ in range(2):
        query = ingested(docs, str(tmp_path / "out"), str(tmp_path / "check"))
        query.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    rows = spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,m,0) ts, 'a' u, 1.0 v from values (0),(10),(55),(1500) t(m)")
    assert sorted(r.n for r in windowed_counts(rows, "ts", "u", "v").collect()) == [1, 3]
    assert sorted(r.n for r in sessions(rows, "ts", "u").collect()) == [1, 1, 2]
