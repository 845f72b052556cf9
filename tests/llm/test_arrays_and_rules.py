"""Array-based operators against brute force on small texts: repetition, pieces, licenses, signatures."""

import hashlib
import os
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lowtide.llm import license_scan as L
from lowtide.llm import repetition as R
from lowtide.llm import spotsigs as S
from lowtide.llm import tool_links as T
from lowtide.llm import url_filter as U
from lowtide.llm.arrays import blocks
from lowtide.llm.queries import PIECES

EDGES = [None, "", " ", "a", "\n", "a\n\na\n", "x " * 300, "é 😀 ß\t" * 40, "\u00a0word", "w" * 5000]


def texts(seed: int, n: int = 80) -> list:
    rng = random.Random(seed)
    words = ["the", "of", "é", "Dog", "cat.", "x", "😀", "loser,", "und", "la"]
    out = list(EDGES)
    for _ in range(n):
        body = " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))
        out.append(body + ("\n" + body) * rng.randint(0, 2))
    return out


def frame(spark, values):
    return spark.createDataFrame([(i, t) for i, t in enumerate(values)], "doc_id long, text string")


def brute_repetition(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")

    def cover(size):
        seen = Counter(tuple(words[i: i + size]) for i in range(len(words) - size + 1))
        return len({i + k for i in range(len(words) - size + 1) if seen[tuple(words[i: i + size])] > 1 for k in range(size)})

    longest = 0
    while max(Counter(tuple(words[i: i + longest + 1]) for i in range(len(words) - longest)).values(), default=0) > 1:
        longest += 1
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            cover(8), cover(5), longest)


def test_repetition_is_brute_force(spark):
    values = texts(1)
    got = {r.doc_id: r for r in R.measure(frame(spark, values)).collect()}
    for i, text in enumerate(values):
        r = got[i]
        want = brute_repetition(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.covered_words, r.longest_run) == want, text
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r.kept == (not r.base_failed and 100 * want[5] <= 40 * want[0] and want[6] <= 50)


def test_kept_rows_keep_their_columns(spark):
    docs = frame(spark, texts(2)).selectExpr("*", "doc_id % 3 as n_words", "'x' as kept")
    kept = R.keep_clean(docs)
    assert kept.schema == docs.schema
    verdict = {r.doc_id for r in R.measure(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == verdict
    assert R.keep_clean(docs.limit(0)).count() == 0


pieces = pytest.mark.skipif(not os.path.exists(PIECES), reason="no piece file")


@pieces
def test_pieces_come_back_and_score_best(spark):
    from lowtide.llm import sentencepiece as P

    model = P.load(PIECES)
    known = {model.data[model.offsets[i]: model.offsets[i + 1]].tobytes(): i for i in range(len(model.scores))
             if model.scores[i] < 0 or i == int(model.scores.nonzero()[0][0]) - 1}
    values = [*texts(3, 30), "▁x▁ ▁", "日本語 😀x", "\n\n\ta", "  two  spaces "]
    memo = P.Memo(most=4)
    for text in values:
        for block in blocks(pa.array([text or ""])):
            ids, offsets = P.encode_block(block, model, memo)
            assert P.decode_block(ids.astype("int64"), offsets, model)[0].decode() == (text or "")
            if len(text or "") > 400:
                continue
            chars = [c.encode() for c in " " + text] if text else []
            best = [0.0] + [float("-inf")] * len(chars)
            for i, c in enumerate(chars):
                if c not in known:
                    best[i + 1] = max(best[i + 1], best[i] + model.unknown)
                for j in range(i + 1, min(len(chars), i + 17) + 1):
                    piece = b"".join(chars[i:j])
                    if piece in known:
                        best[j] = max(best[j], best[i] + model.scores[known[piece]])
            raw = b"".join(bytes([model.byte_ids.tolist().index(i)]) for i in ids.tolist() if i in set(model.byte_ids.tolist()))
            got = sum(model.scores[i] for i in ids.tolist()) + model.unknown * len(raw.decode())
            assert got == pytest.approx(best[-1])


@pieces
def test_piece_columns(spark):
    from lowtide.llm import sentencepiece as P

    docs = frame(spark, texts(4, 10)).selectExpr("*", "1 as ids")
    coded = P.encode(docs, PIECES)
    back = {r.doc_id: (r.text, r.decoded, r.piece_ids) for r in P.decode(coded, PIECES).collect()}
    assert all(a == b for a, b, _ in back.values()) and back[0][2] is None and back[1][2] == []
    with pytest.raises(ValueError):
        P.encode(docs, PIECES, ids="ids")
    trip = {r.doc_id: r for r in P.round_trip(docs, PIECES).collect()}
    for i, (text, _, ids) in back.items():
        assert trip[i].exact and trip[i].piece_ids == ids
        assert trip[i].decoded_sha256 == (None if text is None else hashlib.sha256(text.encode()).hexdigest())


def test_licenses_found_and_spans(spark):
    rng = random.Random(5)
    noise = lambda n: " ".join("".join(rng.choice("abcdef") for _ in range(6)) for _ in range(n))
    values, want = list(EDGES), []
    for name, text in L.TEMPLATES.items():
        for before in (0, 1, 7, 40):
            values.append(f"{noise(before)} {text.upper()} {noise(30)}".strip())
            want.append((len(values) - 1, name, before, before + len(text.split())))
        long = text.split()
        if len(long) > 30:
            long[4] = "changed"
            values.append(f"{noise(9)} {' '.join(long)} {noise(9)}")
            want.append((len(values) - 1, name, None, None))
    got = {(r.doc_id, r.template): r for r in L.scan(frame(spark, values)).collect()}
    for doc, name, start, end in want:
        assert (doc, name) in got
        if start is not None:
            assert (got[doc, name].first_word, got[doc, name].end_word) == (start, end) and got[doc, name].containment == 1
    assert all(doc >= len(EDGES) for doc, _ in got)
    assert L.collision(0.41) > 0.999


def _likeness(a, b):
    a, b = ({x[i: i + 8] for i in range(0, len(x), 8)} for x in (a, b))
    return len(a & b) / len(a | b)


def test_edited_neighbours(spark):
    values = texts(6, 60)
    docs = frame(spark, values).union(spark.createDataFrame([(3, "twice the id"), (-5, "the first of all")], "doc_id long, text string"))
    prints = {r.text: r.fingerprint for r in docs.select("text").distinct().selectExpr("text", "xxhash64(text) as doc_id").join(
        S.fingerprints(docs.selectExpr("xxhash64(text) as doc_id", "text")).distinct(), "doc_id").collect()}
    prints[""] = prints.get("", S.fingerprints(frame(spark, [""])).first().fingerprint)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()))
    got = sorted(((r.doc_id, r.n_chars, r.fingerprint), r) for r in S.compare_edited(docs).collect())
    want = []
    for k, (doc, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        want.append(((doc, len(text), prints[text]), hashlib.sha256(edited.encode()).hexdigest(), _likeness(prints[text], prints[after])))
    assert [g[0] for g in got] == sorted(w[0] for w in want)
    assert sorted((g[0], g[1].edited_sha256, round(g[1].near_next, 9)) for g in got) == sorted((a, b, round(c, 9)) for a, b, c in want)
    assert all(abs(g[1].near_edited - _likeness(g[1].fingerprint, g[1].edited_fingerprint)) < 1e-9 for g in got)


def test_signature_pairs(spark):
    rng = random.Random(7)
    base = " ".join(f"the w{rng.randint(0, 99)} x{k}" for k in range(40))
    values = [base] + [base.replace(f"x{rng.randint(0, 39)} ", "new ", 1) for _ in range(12)] + texts(8, 30) + [base, base]
    prints = S.fingerprints(frame(spark, values))
    sets = {}
    for r in prints.collect():
        sets[r.fingerprint] = min(r.doc_id, sets.get(r.fingerprint, r.doc_id))
    items = list(sets.items())
    want = {(min(i, j), max(i, j)) for k, (a, i) in enumerate(items) for b, j in items[:k] if _likeness(a, b) >= 0.75}
    assert {(r.a, r.b) for r in S.near_pairs(prints, 0.75).collect()} == want and len(want) > 10


def test_url_rules_and_models(spark):
    urls = [None, "", "nothing", "http://", "http://NET/", "http://net", "https://a.Example.NET/en/x?y", "http://example.net/de/",
            "x://b.org/fr/#f", "http://org.evil/fr/", "http://example.com/de/1", "http://a://b/c"]
    rows = [(i, u) for i, u in enumerate(urls + [f"http://good{k}.example.net/en/{k}" for k in range(60)]
                                          + [f"http://spam{k}.net/pills/{k}" for k in range(60)] + ["http://spam9.com/pills/9", "http://good9.com/en/9"])]
    got = {r.page_id: r for r in U.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    named = [(r.host, r.path, r.rule) for r in (got[i] for i in range(len(urls)))]
    assert named == [("", "", None)] * 3 + [("", "", None), ("net", "/", "net/"), ("net", "", None), ("a.example.net", "/en/x", "example.net/en/"),
                     ("example.net", "/de/", "net/"), ("b.org", "/fr/", "org/fr/"), ("org.evil", "/fr/", None),
                     ("example.com", "/de/1", "example.com/de/"), ("a:", "//b/c", None)]
    assert (got[len(rows) - 2].verdict, got[len(rows) - 1].verdict) == ("block", "allow")
    one = spark.createDataFrame([(1, "http://x.y/z")], "page_id long, url string")
    assert U.judge(one).first().ratio == 0 and U.judge(one.limit(0)).count() == 0


def test_tool_links(spark):
    calls = [("c", "a", 1, "f", '{ "b":1.50, "a" : "é" }', None), ("c", "b", 3, "f", '{"a": 2}', "a"), ("c", "b", 4, "f", "{}", None),
             ("c", "x", 5, "g", "no json", "none"), ("c", "p", 6, "f", '{"a":"1"}', "q"), ("c", "q", 7, "f", '{"a":"1","z":NaN}', "p"),
             (None, "a", 1, "f", '{"a":"k"}', None)] + [("d", f"k{i}", i, "f", '{"a":"t"}', f"k{i - 1}") for i in range(40)]
    results = [("c", "a", 2, "r1"), ("c", "a", 9, "r2"), ("c", "o", 3, "left"), ("c", None, 3, "none")]
    schema = {"f": {"required": ["a"], "properties": {"a": {"type": "string"}, "b": {"type": "number", "maximum": 1}}}}
    df = T.link(spark.createDataFrame(calls, "conv_id string, call_id string, turn int, name string, arguments string, after string"),
                spark.createDataFrame(results, "conv_id string, call_id string, turn int, content string"), schema)
    got = {(r.conv_id, r.call_id): r for r in df.collect()}
    assert len(got) == 6 + 1 + 1 + 1 + 40 - 1
    a = got["c", "a"]
    assert (a.status, a.level, a.call_turn, a.result_turn, a.n_results, a.canonical, a.errors) == (
        "linked", 0, 1, 2, 2, '{"a":"é","b":1.5}', ".b: out of range")
    assert (got["c", "b"].level, got["c", "b"].n_calls, got["c", "b"].errors) == (2, 2, ".a: not string")
    assert (got["c", "x"].errors, got["c", "x"].canonical) == ("no such tool; no such dependency", None)
    assert got["c", "p"].level is None and got["c", "q"].level is None and got["c", "q"].canonical is None
    assert got["c", "o"].status == "orphan" and got[None, "a"].status == "open"
    assert [got["d", f"k{i}"].level for i in range(40)] == [2 * i for i in range(40)]


@pytest.mark.parametrize("text, want", [
    ('{"a":"\\ud800"}', '{"a":"\\ud800"}'), ('{"\\udc00":1}', '{"\\udc00":1}'), ('{"a":"\\ud83d\\ude00"}', '{"a":"😀"}'),
    ('{"a":1e999}', None), ('{"a":-1e999}', None), ('{"a":NaN}', None), ('{"a":Infinity}', None), ('{"b":1.0,"a":1e0}', '{"a":1,"b":1}'),
    ('{"a":-0.0}', '{"a":0}'), ('{"a":0.10}', '{"a":0.1}'), ('{"a":1e300}', '{"a":1e+300}'), ("[" * 100_000, None), ("", None), (None, None)])
def test_canonical_json(text, want):
    assert T.canonical(text)[1] == want


def test_tool_links_take_any_text(spark):
    calls = [("c", f"x{k}", k, "t", a, None) for k, a in enumerate(['{"\\ud800":1}', '{"n":"\\udfff"}', '{"n":1e999}', "{", None, "x" * 200_000])]
    df = T.link(spark.createDataFrame(calls, "conv_id string, call_id string, turn int, name string, arguments string, after string"),
                spark.createDataFrame([], "conv_id string, call_id string, turn int, content string"), {"t": {"properties": {"n": {"type": "string"}}}})
    got = {r.call_id: (r.errors, r.canonical) for r in df.collect()}
    assert got["x0"] == (".\\ud800: unknown", '{"\\ud800":1}') and got["x1"] == ("", '{"n":"\\udfff"}')
    assert all(got[f"x{k}"] == (".: not object", None) for k in range(2, 6))
    none = spark.createDataFrame([], "conv_id string, call_id string, turn int, name string, arguments string, after string")
    assert T.link(none, spark.createDataFrame([], "conv_id string, call_id string, turn int, content string"), {}).count() == 0


def test_recode_is_encode_and_decode(spark):
    from lowtide.llm import sentencepiece as P

    docs = frame(spark, texts(21)).withColumn("place", F.lit(1))
    both = P.decode(P.encode(docs, PIECES), PIECES)
    want = sorted((r.doc_id, r.decoded, r.piece_ids) for r in both.collect())
    once = P.recode(docs, PIECES)
    assert once.columns == ["doc_id", "text", "place", "piece_ids"]
    assert sorted((r.doc_id, r.text, r.piece_ids) for r in once.collect()) == want
    assert P.recode(docs.limit(0), PIECES).count() == 0
