"""Operators over sections: spans, lines, survivorship, near duplicates, canonical text, splitting."""

import random
import re
import unicodedata
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import canonical, lines, near, rolling, spans, splitting, survivorship

SECTION = "ord bigint, id string, source_stem string, source_book string, heading_path array<string>, text string, duplicate_of string, doc string, line_no string, key string, node string, bit string"


def sections(spark, rows):
    """Rows of (ord, id, stem, book, path, text, duplicate_of), with extra columns whose names clash with those inside the operators."""
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SECTION)


def simple(spark, texts, stem="s-1"):
    return sections(spark, [(n, f"i{n:03d}", stem, None, None, t, None) for n, t in enumerate(texts)])


def han(n, seed, size=3000):
    rng = random.Random(seed)
    return "".join(chr(0x4E00 + rng.randrange(size)) for _ in range(n))


# --- spans -----------------------------------------------------------------------------------------


def brute_spans(rows, least):
    owners = defaultdict(set)
    for key, text in rows:
        for i in range(len(text or "") - least + 1):
            owners[text[i : i + least]].add(key)
    out = set()
    for key, text in rows:
        at = None
        for i in range(len(text or "") - least + 1):
            if len(owners[text[i : i + least]]) > 1:
                if at and i <= at[1]:
                    at[1] = i + least
                else:
                    if at:
                        out.add((key, *at))
                    at = [i, i + least]
        if at:
            out.add((key, *at))
    return out


@pytest.mark.parametrize("least", [80, 20])
def test_spans_equal_brute_force(spark, least):
    base = han(2000, 1)
    long = base * 15
    texts = [base[:300], "头" + base[100:260] + "尾", base[100 : 100 + least], base[100 : 99 + least], None, "", "aaaa" * 60, "aaaa" * 70, base[500:600] + han(50, 2) + base[550:700], "的" * 79 + "😀" + base[:90], long, base[:300] + "\r\n" + base[:300]]
    rows = [(f"i{n:03d}", t) for n, t in enumerate(texts)]
    df = simple(spark, texts)
    found = spans.shared_spans(df.unionByName(df.withColumn("ord", F.col("ord") + 100)), least)
    got = [(r.id, r.span_start, r.span_end) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == brute_spans(rows, least)
    share = {r.id: r.share for r in spans.shared_share(df, found).collect()}
    assert share["i005"] == 0.0 and share["i004"] == 0.0 and share["i000"] == 1.0


def test_one_id_delivered_twice_shares_nothing(spark):
    df = simple(spark, [han(200, 3)])
    assert spans.shared_spans(df.unionByName(df)).count() == 0
    assert spans.shared_spans(df.limit(0)).count() == 0


def test_rolling_hash_ignores_position():
    text = han(300, 4) + "😀" + han(50, 5)
    points = rolling.code_points([text])
    grams = rolling.Rolling(points).grams(7)
    assert all(grams[i] == rolling.Rolling(points[i : i + 7]).grams(7)[0] for i in (0, 5, 200, 299, 344))
    assert rolling.Rolling(points[:3]).grams(7).size == 0
    assert list(rolling.chunks(["a" * 5, "b" * 9, "c"], 6)) == [(0, 1), (1, 2), (2, 3)]


# --- lines ------------------------------------------------------------------------------------------


def test_lines(spark):
    share = ["请分享 12 次", "请分享 ３ 次 ", "\t请分享　77 次", "请分享 1 次\r"]
    texts = [f"正文{chr(0x4E00 + n)}\n{share[n % 4]}\n\n  \n尾{n % 2}" for n in range(9)]
    rows = [(n, f"i{n}", "s-1", None, None, t, None) for n, t in enumerate(texts)]
    rows += [(50 + n, "i0", "s-1", None, None, texts[0], None) for n in range(9)]  # many deliveries of one id count once
    rows += [(100 + n, f"j{n}", "s-2", None, None, "请分享 1 次", None) for n in range(7)]  # another source stays below
    rows += [(200, "n1", "s-1", None, None, None, None), (201, "n2", None, None, None, "请分享 1 次", None), (202, "n3", "s-1", None, None, "", None)]
    found = lines.repeated_lines(sections(spark, rows)).collect()
    assert {(r.id, r.line_no) for r in found} == {(f"i{n}", m) for n in range(9) for m in (2, 5)} and len(found) == 18
    df = sections(spark, rows)
    left = {r.id: r.text for r in lines.remove_lines(df, lines.repeated_lines(df)).collect()}
    assert left["i3"] == "正文" + chr(0x4E03) + "\n\n  " and left["j0"] == "请分享 1 次" and left["n1"] is None and left["n3"] == ""
    assert lines.repeated_lines(df.limit(0)).count() == 0


def test_lines_over_blocks_of_documents(spark):
    rows = [(n * 20_000, f"i{n}", "s", None, None, "同一行", None) for n in range(8)]
    assert lines.repeated_lines(sections(spark, rows)).count() == 8
    assert lines.repeated_lines(sections(spark, rows[:7])).count() == 0


# --- survivorship -------------------------------------------------------------------------------------


def test_survivors(spark):
    rows = [
        (1, "a", "lanting-1", "书一", None, "xx", "b"), (2, "b", "moshan-1", "书二", None, "xxxx", "c"), (3, "c", "nope-1", "书三", None, None, "a"), (4, "d", "moshan-2", " ", None, "x", "b"),
        (5, "e", "lanting-2", "N/A", None, "same", "f"), (6, "f", "lanting-3", "無", None, "same", None), (7, "g", None, None, None, None, "h"), (8, "h", "lv-1", "书四", None, None, None),
        (9, "i", "lv-1", "书", None, "x", "i"), (10, "j", "lv-1", "书", None, "x", "absent"), (11, "a", "lanting-1", "书一", None, "xx", "b"), (12, "k", "lanting-1", "书", None, "", None), (13, None, "x", "x", None, "x", "a"),
    ]
    imprints = spark.createDataFrame([("lanting", 5, "x"), ("moshan", 2, "x"), ("lv", None, "x"), ("lv", None, "y")], "imprint string, trust int, id string")
    found = survivorship.survivors(sections(spark, rows), imprints)
    assert {tuple(r) for r in found.collect()} == {("a", "b", "书一"), ("e", "e", None), ("g", "g", "书四")}
    assert survivorship.survivors(sections(spark, rows).limit(0), imprints).count() == 0


def test_stand_ins_name_no_book(spark):
    stand_ins = ["（待补）", "(待补)", "待补", "【待補】", " [ 待補 ] ", "（未知）", "Ｎ／Ａ", "(Unknown)", "（）", "？", None]
    titles = ["待补的脸", "看见（待补）之后", "读脸手册（上）", "（新编）读脸手册", "qinghe-000000#2"]
    rows = spark.createDataFrame([(b,) for b in stand_ins + titles], "book string")
    assert [r[0] for r in rows.select(survivorship.names_a_book(F.col("book"))).collect()] == [False] * len(stand_ins) + [True] * len(titles)
    df = sections(spark, [(1, "a", "lanting-1", "（待补）", None, "xxxx", "b"), (2, "b", "moshan-1", "书二", None, "x", None)])
    imprints = spark.createDataFrame([("lanting", 5), ("moshan", 2)], "imprint string, trust int")
    assert [tuple(r) for r in survivorship.survivors(df, imprints).collect()] == [("a", "a", "书二")]


# --- near duplicates ------------------------------------------------------------------------------------


def brute_pairs(rows, least=0.55):
    sets = {}
    for key, text in rows:
        bare = "".join(c for c in unicodedata.normalize("NFKC", text or "") if unicodedata.category(c)[0] in "LN")
        if len(bare) >= 40:
            sets[key] = {bare[i : i + 5] for i in range(len(bare) - 4)}
    keys = sorted(sets)
    return {(a, b) for n, a in enumerate(keys) for b in keys[n + 1 :] if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])}


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(6)
    texts = [None, "", "短", "x" * 300, "x" * 301, "，" * 100]
    for n in range(60):
        base = list(han(rng.choice([41, 80, 200, 900]), 100 + n // 4, 400))
        for _ in range(rng.randrange(0, max(2, len(base) // 40))):
            base[rng.randrange(len(base))] = rng.choice(["手", "", "新加的"])
        texts.append("，".join(["".join(base[:20]), "".join(base[20:])]))
    texts += [texts[10], texts[10] + "。"]
    df = simple(spark, texts)
    got = [tuple(r) for r in near.near_pairs(df.unionByName(df)).collect()]
    want = brute_pairs([(f"i{n:03d}", t) for n, t in enumerate(texts)])
    assert len(got) == len(set(got)) and set(got) <= want and len(want) > 20
    assert len(set(got)) >= 0.99 * len(want)
    assert near.near_pairs(df.limit(0)).count() == 0


def test_near_pairs_that_share_only_frequent_shingles(spark):
    hot = han(300, 1)
    texts = [(hot if n % 3 == 0 else han(300, 1000 + n)) + han(100, 2000 + n) for n in range(150)]
    want = brute_pairs([(f"i{n:03d}", t) for n, t in enumerate(texts)])
    assert len(want) == 50 * 49 // 2
    got = [tuple(r) for r in near.near_pairs(simple(spark, texts)).collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.99 * len(want)


def test_weighted_sampling_estimates_weighted_jaccard():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2**63, 600).astype(np.uint64))
    b = np.r_[a[:400], np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))]
    weight = lambda g: (1 + (g % np.uint64(7))).astype(np.float32)
    both = weight(a[:400]).sum()
    want = both / (weight(a).sum() + weight(b).sum() - both)
    signs = [near.signatures(1, np.zeros(len(g), np.int64), g, weight(g))[0] for g in (a, b)]
    assert abs((signs[0] == signs[1]).mean() - want) < 0.13
    tiny = near.signatures(2, np.array([0, 1, 1]), a[:3], weight(a[:3]))
    assert len(set(tiny[0])) == 1 and set(tiny[1]) <= {int(x & np.uint64(0xFFFFFFFF)) for x in a[1:3]}
    assert len(near.band_keys(tiny)[0]) == near.BANDS


# --- canonical text ---------------------------------------------------------------------------------------

ODD = {
    "ＡＢ３": ("wide", "AB3"), "café x": ("mark", "café x"), "相​信": ("hidden", "相信"), "a b c": ("space", "a b c"), "⼿⼼": ("form", "手心"), "FаСS": ("mixed", "FaCS"), "﻿头": ("hidden", "头"),
    "是‍否": ("hidden", "是否"), "\uf900": ("form", "\u8c48"), "a­b": ("hidden", "ab"), "sіgnal记": ("mixed", "signal记"),
}
PLAIN = ["", "\uff0c\u3002\uff1a\uff08\u5168\u89d2\uff09\uff01", "\u3000\u3000\u7f29\u8fdb\t\r\n", "\u03bc\u03bf\u03c1\u03c6\u03ae\u548c\u03bc\u8282\u5f8b", "\u0436\u0435\u0441\u0442\u4e0e\u0443\u043b\u044b\u0431\u043a\u0430", "na\u00efve caf\u00e9 r\u00e9sum\u00e9", "\U0001f469\u200d\U0001f3eb\U0001f468\u200d\U0001f469\u200d\U0001f467", "\u2764\ufe0f ok 1\ufe0f\u20e3", "\U00020000\U00020bb7", "\ufa0e", "AU12 3.5%"]


def test_canonical_forms():
    for text, (kind, form) in ODD.items():
        assert kind in canonical.classes_of(f"前{text}后"), text
        assert canonical.canonical(f"前{text}后") == f"前{form}后", text
    for text in PLAIN:
        assert canonical.classes_of(text) == [] and canonical.canonical(text) == text
    assert canonical.canonical(None) is None and canonical.classes_of(None) == []
    rng = random.Random(7)
    for _ in range(300):
        text = "".join(rng.choice([*ODD, *PLAIN, "字"]) for _ in range(8))
        once = canonical.canonical(text)
        assert canonical.canonical(once) == once


def test_uncommon_fields(spark):
    rows = [(1, "a", None, None, ["正常", "ＡＢ"], "好", None), (2, "b", None, None, [None, "x"], "café", None), (3, "c", None, None, [], None, None), (4, "d", None, None, None, "", None), (5, "a", None, None, ["正常", "ＡＢ"], "好", None), (6, "e", None, None, ["a​b"], "好" * 100_000 + " ", None)]
    df = sections(spark, rows)
    assert {(r.id, r.field) for r in canonical.uncommon_fields(df).collect()} == {("a", "heading_path"), ("b", "text"), ("e", "text"), ("e", "heading_path")}
    fixed = {r.id: r for r in canonical.canonical_sections(df).collect()}
    assert fixed["a"].heading_path == ["正常", "AB"] and fixed["b"].text == "café" and fixed["b"].heading_path == [None, "x"] and fixed["c"].text is None and fixed["d"].heading_path is None
    assert canonical.uncommon_fields(canonical.canonical_sections(df)).count() == 0
    assert canonical.uncommon_fields(df.limit(0)).count() == 0


# --- splitting ----------------------------------------------------------------------------------------------


def test_range_maximum():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5, 300)
    table = splitting.RangeMaximum(values, 100)
    for _ in range(500):
        low = int(rng.integers(0, 299))
        high = int(rng.integers(low + 1, min(low + 101, 301)))
        best = max(range(low, high), key=lambda i: (values[i], i))
        assert table.rightmost(low, high) == best


def check_pieces(text, limit, overlap):
    found = splitting.split_spans(text, limit, overlap)
    assert found[0][0] == 0 and found[-1][1] == len(text)
    for (a, b), (c, d) in zip(found, found[1:], strict=False):
        assert 0 <= b - c <= overlap and a < c and b < d
    assert all(b - a <= limit for a, b in found)
    rebuilt = "".join(text[a:b] if n == 0 else text[found[n - 1][1] : b] for n, (a, b) in enumerate(found))
    assert rebuilt == text
    return found


def test_pieces_cover_and_end_at_boundaries():
    rng = random.Random(8)
    for n in range(60):
        parts = [han(rng.randint(1, 60), n) + rng.choice(["。", "，", "\n", "\n\n", " ", "”\n"]) for _ in range(rng.randint(1, 300))]
        text = "".join(parts)
        found = check_pieces(text, 400, 40)
        for _, b in found[:-1]:
            assert text[b - 1] in "。，\n ”" or not re.search(r"[。，\n ]", text[b - 200 : b])
    for text in ("", "x", "x" * 4000, "x" * 4001, "字" * 20_000, "\n" * 9000, "é" * 5000):
        check_pieces(text, 4000, 200)
    assert [b for _, b in check_pieces("a" * 250 + "\n\n" + "b" * 140 + "。" + "c" * 300, 400, 0)][0] == 252
    with pytest.raises(ValueError):
        splitting.split_spans("x" * 10, 4, 2)


def test_split_oversized(spark):
    df = simple(spark, [None, "", "a" * 4000, "句子。" * 2000, "x" * 300_000])
    got = defaultdict(list)
    for r in splitting.split_oversized(df).collect():
        got[r.id].append(r)
    assert "i000" not in got and [len(got[f"i00{n}"]) for n in (1, 2)] == [1, 1] and len(got["i003"]) == 2 and len(got["i004"]) > 75
    assert all(r.end - r.start == len(r.piece) <= 4000 for rows in got.values() for r in rows)
    assert splitting.split_oversized(df.limit(0)).count() == 0


# --- hot groups -----------------------------------------------------------------------------------------------


def test_a_third_of_all_rows_alike(spark):
    hot = han(200, 50) + "\n请分享本页\n" + han(100, 51)
    texts = [hot if n % 3 == 0 else han(150, 1000 + n) for n in range(300)]
    df = simple(spark, texts)
    found = spans.shared_spans(df).collect()
    assert {(r.id, r.span_start, r.span_end) for r in found} == {(f"i{n:03d}", 0, len(hot)) for n in range(0, 300, 3)}
    assert lines.repeated_lines(df).count() == 300
    members, links = near.near_classes(df)
    assert links.count() == 0 and members.groupBy("doc").count().agg(F.max("count")).first()[0] == 100
    chained = sections(spark, [(n, f"i{n:03d}", "s-1", "书", None, "x" * n, "i299" if n < 299 else None) for n in range(300)])
    imprints = spark.createDataFrame([("s", 1)], "imprint string, trust int")
    assert [tuple(r) for r in survivorship.survivors(chained, imprints).collect()] == [("i000", "i299", "书")]


def test_canonical_form_is_closed():
    others = [chr(c) for c in range(0x370, 0x530) if canonical._OTHER.match(chr(c))]
    for c in others:
        for a in "aZkq":
            for word in (a + c, c + a, a + c + a, c + a + c):
                settled = canonical.canonical(word)
                assert canonical.classes_of(settled) == [] and canonical.canonical(settled) == settled, word
    for word, want in {"kот": "kot", "кoт": "кот", "тext": "text", "вook": "book", "gоmма": "gomma", "привeт": "привет", "ﬁne": "fine", "ｶﾅ": "カナ", "é": "é", "αβγ": "αβγ", "①²…！": "①²…！"}.items():
        assert canonical.canonical(word) == want, word
    for text in ("x́", "́", "你́​好", "ｗ́  ", "⼈一"):
        assert canonical.classes_of(canonical.canonical(text)) == []
