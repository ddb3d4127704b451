"""Long and broken inputs in linear time, repeated ids, columns whose names clash."""

import hashlib
import re
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hearth.llm import balltree, html_extract, mixing, secrets
from hearth.llm.common import prefix_sums, words


@pytest.mark.parametrize("block", [1024, 2])  # in one block and in several
def test_top_k_of_ids_with_several_vectors(spark, block):
    vectors = [(k % 90, [float((k * 7 + j * 3) % 11) / 256 - 0.01 for j in range(4)]) for k in range(200)]
    v = balltree.integer_vectors(spark.createDataFrame(vectors, "id long, v array<double>"), "id", "v")
    rows = [(r.id, tuple(int(x) for x in r.v)) for r in v.collect()]
    want = []
    for qid, q in rows:
        if qid % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, x)), i) for i, x in rows if i != qid)[:5]
            want += [(qid, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    got = balltree.top_k(v, v.filter("id % 50 = 0"), 5, 40, block)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert len({r for r in rows if r[0] == 50}) > 1


@pytest.mark.parametrize("piece", ["<a ", "<", '<a "', "<!x ", "<!-- <", "<div><p>a</x>", "<script ", "<a xyz=", "<a '\""])
def test_broken_markup_in_linear_time(piece):
    began = time.time()
    for end in ("", ">"):
        html_extract.page_lines(piece * (1_000_000 // len(piece)) + end)
    assert time.time() - began < 20


def test_alignment_of_long_pages(monkeypatch):
    began = time.time()
    assert html_extract.shared_lines([f"a{k}" for k in range(60_000)], [f"b{k}" for k in range(60_000)]) == set()
    assert time.time() - began < 60
    a, b = [f"{k % 97}" for k in range(900)], [f"{k * 5 % 89}" for k in range(800)]
    whole = html_extract.shared_lines(a, b)
    monkeypatch.setattr(html_extract, "ALIGN_BITS", 5000)
    halves = html_extract.shared_lines(a, b)
    assert len(halves) == len(whole)
    it = iter(b)
    assert all(a[i] in it for i in sorted(halves))  # a common subsequence


def test_words_of_long_blanks(spark):
    rows = [(0, " " * 1_000_000), (1, "a" + " \t\n" * 300_000 + "b"), (2, None), (3, ""), (4, " x ")]
    began = time.time()
    got = {r.k: r.w for r in spark.createDataFrame(rows, "k int, t string").select("k", words(F.col("t")).alias("w")).collect()}
    assert got == {0: [], 1: ["a", "b"], 2: [], 3: [], 4: ["x"]}
    assert time.time() - began < 20


def test_prefix_sums(spark):
    rows = [(n, [(k * 37) % 11 for k in range(n)]) for n in (0, 1, 2, 255, 256, 257, 5000)]
    got = {r.n: r.s for r in spark.createDataFrame(rows, "n int, a array<int>").select("n", prefix_sums(F.col("a")).alias("s")).collect()}
    for n, a in rows:
        assert got[n] == [sum(a[:k + 1]) for k in range(n)]


def checksums(n):
    return "\n".join(f"{hashlib.sha256(str(k).encode()).hexdigest()}  größe{k}.txt" for k in range(n))


def test_many_secrets_in_one_text(spark):
    text = checksums(40_000)
    df = spark.createDataFrame([(1, text, 5), (2, None, None), (3, "plain", 5)], "doc_id long, text string, n_chars long")
    began = time.time()
    got = {r.doc_id: r for r in secrets.report(df).collect()}
    places = [(m.start(), m.end()) for m in re.finditer("[0-9a-f]{24,}", text)]
    assert got[1].n_hex == len(places)
    assert got[1].base_sha256 == hashlib.sha256(",".join(f"hex:{s}:{e}" for s, e in places).encode()).hexdigest()
    clean = {r.doc_id: r for r in secrets.redact(df).collect()}
    assert clean[1].text == re.sub("[0-9a-f]{24,}", "[SECRET]", text) and clean[1].n_chars == len(clean[1].text)
    assert clean[2].text is None and clean[3].text == "plain"
    assert time.time() - began < 120


def test_replaced_spans(spark):
    text = "".join(chr(97 + k % 26) if k % 7 else "ß" for k in range(9000))
    cases = [[], [(0, 3)], [(0, 9000)], [(8999, 9000)], [(4095, 4097), (4096, 5000), (4500, 4600)], [(0, 4096), (4096, 8192)],
             [(100, 9000), (200, 300), (400, 500)]]
    rows = [(k, text, [(s, 0, e, "x") for s, e in c]) for k, c in enumerate(cases)]
    df = spark.createDataFrame(rows, f"k int, text string, spans {secrets.SPAN.replace(':', ': ')}")
    got = {r.k: r.t for r in df.select("k", secrets.replaced(F.col("text"), F.col("spans"), "#").alias("t")).collect()}
    for k, c in enumerate(cases):
        out, at = "", 0
        for s, e in c:
            if s >= at:
                out += text[at:s] + "#"
            at = max(at, e)
        assert got[k] == out + text[at:], c


CLASH = ("size", "spans", "base", "_s", "_copy", "cid", "key", "row", "copy", "own_source", "target", "w", "t", "clean")


@pytest.fixture(scope="module")
def with_extras(spark):
    rows = [(k, " ".join(f"w{(k * 13 + j) % 977}" for j in range(12 + k % 30)) + (" password=abcdef123" if k % 9 == 0 else ""),
             "en", f"s{k % 4}", 7) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.concat(F.lit(c + "-"), F.col("doc_id")) for c in CLASH})


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_a_users_columns(spark, with_extras, name, stage):
    out = stage(spark, with_extras, "/root/testdata/sf0.001")
    assert out.columns == with_extras.columns
    rows = out.collect()
    assert rows and all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in CLASH)


def test_mix_plan_and_mix_agree(spark, with_extras):
    plan = {r.doc_id: r.n_copies for r in mixing.mix_plan(with_extras).collect()}
    got = {}
    for r in mixing.mix(with_extras).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: n for k, n in plan.items() if n}
