import hashlib
import itertools
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import similarity
from lectern.operators.similarity import SEED, Signer, _sharing, dominant_stem_pair, duplicate_components, normalized, novel_paragraphs, overlap_pairs
from lectern.queries import catalogue


def plain_signature(text):
    if len(text) < 40:
        return None
    n = normalized(text)
    hashes = [int.from_bytes(hashlib.sha256(struct.pack(">I", SEED) + n[i : i + 5].encode()).digest()[:4], "big") for i in range(len(n) - 4)]
    out = []
    for i in range(128):
        a, b = struct.unpack(">II", hashlib.sha256(struct.pack(">II", SEED, i)).digest()[:8])
        out.append(min(((a | 1) * x + b) % 2**32 for x in hashes))
    return out


def texts():
    random.seed(2)
    make = lambda n: "".join(chr(0x4E00 + random.randrange(3000)) for _ in range(n))
    rows = [(f"r{i:03d}", make(random.randint(60, 200))) for i in range(25)]
    for i in range(20):
        base = list(rows[i][1])
        for _ in range(i // 2):
            base[random.randrange(len(base))] = "眼"
        rows.append((f"s{i:03d}", "".join(base)))
    return [*rows, ("t1", "短文"), ("t2", "短，文"), ("t3", None), ("t4", "")]


def test_signatures():
    signer = Signer()
    for _, text in texts()[:6]:
        assert list(signer.of(text)) == plain_signature(text)
    assert signer.of("x" * 39) is None and signer.of("，" * 50) is None and signer.of(None) is None


def test_signatures_of_many_texts():
    signer = Signer()
    rows = [t for _, t in texts()] + ["，" * 50, "多" * 60, "".join(chr(0x4E00 + i) for i in range(8000)), "a\ud800" * 30] + ["".join(chr(0x4E00 + i) for i in range(k, k + 6000)) for k in (0, 5000)]
    for a, b in zip(signer.many(rows), map(signer.of, rows), strict=True):
        assert (a is None) == (b is None) and (a is None or list(a) == list(b))
    assert signer.many([]) == []


def test_candidates_are_all_pairs_that_can_agree_and_few_others(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**31), 2**31, (60, 128))
    rows = [(i, base[i]) for i in range(60)]
    for i in range(60):  # rows 100 to 129 agree with theirs in 71 slots, the others in 32: bands of two slots would often meet there
        other, kept = rng.integers(-(2**31), 2**31, 128), rng.permutation(128)[: 71 if i < 30 else 32]
        other[kept] = base[i][kept]
        rows.append((100 + i, other))
    signed = spark.createDataFrame([(i, [int(x) for x in v]) for i, v in rows], "no bigint, signature array<int>")
    found = {(r.x, r.y) for r in _sharing(signed, 0.55).collect()}
    assert {(i, 100 + i) for i in range(30)} <= found and len(found) <= 35
    close = spark.createDataFrame([(0, [1] * 128), (1, [2 if i % 11 == 0 else 1 for i in range(128)]), (2, [2 if i % 7 == 0 else 1 for i in range(128)])], "no bigint, signature array<int>")
    assert {(r.x, r.y) for r in _sharing(close, 0.9).collect()} == {(0, 1)}
    with pytest.raises(ValueError, match="half"):
        _sharing(signed, 0.5)


def test_pairs_are_those_of_all_comparisons(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t, f"st{n % 3}", len(t or "")) for n, (i, t) in enumerate(rows)], "id string, text string, source_stem string, char_count int")
    signer = Signer()
    signs = {i: signer.of(t) for i, t in rows}
    want = {(a, b) for a, b in itertools.combinations(sorted(i for i, _ in rows), 2) if signs[a] is not None and signs[b] is not None and (signs[a] == signs[b]).mean() >= 0.55}
    found = overlap_pairs(docs.unionByName(docs)).cache()
    got = found.collect()
    assert {tuple(sorted((r.a, r.b))) for r in got if signs[r.a] is not None} == want
    assert [(r.a, r.b, r.jaccard, r.relation) for r in got if r.a == "t1"] == [("t1", "t2", 0.0, "exactish")]
    groups = {r.id: r.canonical for r in duplicate_components(docs, found).collect()}
    assert groups["t1"] == groups["t2"] == "t2"
    assert groups["r000"] == groups["s000"] == "r000"
    best = dominant_stem_pair(docs, found).collect()
    assert len(best) == 1 and best[0].stem_a < best[0].stem_b


@pytest.mark.parametrize("name", ["overlap_components", "dominant_stem_pair"])
def test_only_the_pairs_that_are_used_are_sought(spark, monkeypatch, name):
    rows = [(i, t, f"st{n % 3}") for n, (i, t) in enumerate(texts())]
    docs = spark.createDataFrame(rows, "id string, text string, source_stem string")
    asked = []

    def seek(df, least=similarity.OVERLAP):
        asked.append(least)
        return overlap_pairs(df, least=least)

    all_pairs, sized = overlap_pairs(docs), docs.withColumn("char_count", F.length("text"))
    want = (duplicate_components if name == "overlap_components" else dominant_stem_pair)(sized, all_pairs).collect()
    monkeypatch.setattr(catalogue, "table", lambda *_: docs)
    monkeypatch.setattr(similarity, "overlap_pairs", seek)
    assert sorted(catalogue.queries()[name](spark, "").collect()) == sorted(want) and want
    assert asked == [similarity.EXACTISH]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_dominant_stems_are_those_of_all_comparisons(spark, seed):
    """Copies, near copies and punctuation over many stems: each class's rows count with all others of it, and with all of a near class."""
    rng = random.Random(seed)
    words = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(n)) for n in (39, 39, 60, 90, 12)]
    forms = [f for w in words for f in (w, w + "，。", w + "尾", f"_{w}", w[:20] + "。" + w[20:])]
    rows = [(f"r{i:03d}", rng.choice(forms), f"st{rng.randrange(6)}") for i in range(70)] + [("x1", None, "st0"), ("x2", "", "st1"), ("x3", "。", "st2")]
    signer = Signer()
    signs, bare = {i: signer.of(t) for i, t, _ in rows}, {i: None if t is None else re.sub(r"[^\w]+", "", t) for i, t, _ in rows}
    count = Counter()
    for (a, t, s), (b, u, v) in itertools.combinations(rows, 2):
        near = signs[a] is not None and signs[b] is not None and (signs[a] == signs[b]).mean() >= 0.9
        if s != v and t is not None and u is not None and (near or bare[a] == bare[b]):
            count[min(s, v), max(s, v)] += 1
    stems, most = max(count.items(), key=lambda kv: (kv[1], kv[0]))
    docs = spark.createDataFrame(rows, "id string, text string, source_stem string")
    for least in (0.55, 0.9):
        got = dominant_stem_pair(docs.unionByName(docs), overlap_pairs(docs, least=least)).collect()
        assert [tuple(r) for r in got] == [(*stems, most)]


def test_a_class_whose_first_row_is_short_has_its_links(spark):
    word = "".join(chr(0x4E00 + 7 * i) for i in range(39))
    rows = [("a", word, "st1"), ("b", word + "。", "st2"), ("c", word + "尾", "st3"), ("d", word + "尾。", "st2"), ("e", word + "尾！", "st3")]
    docs = spark.createDataFrame(rows, "id string, text string, source_stem string")
    found = overlap_pairs(docs, least=0.9).cache()
    assert {(r.a, r.b) for r in found.collect()} == {("a", "b"), ("b", "c"), ("c", "d"), ("c", "e")}
    assert [tuple(r) for r in dominant_stem_pair(docs, found).collect()] == [("st2", "st3", 4)]  # b and d with c and e


def test_novel_paragraphs():
    long = "".join(chr(0x4E00 + i) for i in range(60))
    assert novel_paragraphs([long, long + "尾", "新的一段", "短"], [long, "短"]) == ["新的一段"]
