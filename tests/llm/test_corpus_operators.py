"""Search, dedup, packing, mixing, classifier and pipeline against brute force, with the odd cases."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.llm import balltree, components, cotrain, minhash, mixing, packing, suffix_dedup
from hearth.llm.queries import tokenizer_path
from tests.conftest import SF_CHECK, SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/documents.parquet")


def rows_of(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in texts], DOCS)


# --- op4 ----------------------------------------------------------------------

def brute_top_k(rows, k):
    out = set()
    for i, v in rows:
        if i % 50:
            continue
        s = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in rows if j != i)[:k]
        out |= {(i, r + 1, j, -x) for r, (x, j) in enumerate(s)}
    return out


@pytest.mark.parametrize("shard_rows, block", [(10_000, 1024), (60, 3)])
def test_top_k_equals_brute_force(spark, shard_rows, block):
    v = balltree.integer_vectors(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"), "vec_id", "embedding").cache()
    got = balltree.top_k(v, v.filter("id % 50 = 0"), 5, shard_rows, block)
    assert {tuple(r) for r in got.collect()} == brute_top_k([(r.id, [int(x) for x in r.v]) for r in v.collect()], 5)
    v.unpersist()


def test_top_k_ties_nulls_and_sizes(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [0.5, 0.25]) for i in range(0, 300)] + [(1000, None), (1050, [nan, 1.0]), (1100, [inf, 1.0]), (1150, [None, 1.0]),
                                                       (None, [1.0, 1.0]), (0, [0.5, 0.25]), (1200, [1e6, -1e6])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = balltree.integer_vectors(df, "vec_id", "embedding")
    assert v.count() == 301
    got = defaultdict(list)
    for r in sorted(balltree.top_k(v, v.filter("id % 50 = 0"), 3, 50, 4).collect()):
        got[r.query_id].append((r.vec_id, r.score))
    big = (1200, 128 * 256_000_000 - 64 * 256_000_000)
    assert got[0] == [big, (1, 128 * 128 + 64 * 64), (2, 128 * 128 + 64 * 64)]
    assert [x[0] for x in got[50]] == [1200, 0, 1]
    few = v.filter("id < 2")
    assert sorted(tuple(r) for r in balltree.top_k(few, few.filter("id = 0"), 5).collect()) == [(0, 1, 1, 128 * 128 + 64 * 64)]
    assert balltree.top_k(v.limit(0), v.limit(0), 5).count() == 0


# --- op7 ----------------------------------------------------------------------

def shingle_sets(rows):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out[i] = frozenset(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def brute_components(sets):
    order, index, root = Counter(s for v in sets.values() for s in v), defaultdict(list), {k: k for k in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for k, v in sets.items():
        if not v:
            continue
        prefix = sorted(v, key=lambda s: (order[s], s))[:len(v) - -(-75 * len(v) // 100) + 1]
        for c in {c for s in prefix for c in index[s]}:
            both = len(v & sets[c])
            if 100 * both >= 75 * (len(v) + len(sets[c]) - both):
                a, b = find(k), find(c)
                root[max(a, b)] = min(a, b)
        for s in prefix:
            index[s].append(k)
    return {k: find(k) for k in sets}


def check_groups(df):
    sets = shingle_sets([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    want = brute_components(sets)
    for r in minhash.groups(df).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_near_dedup_equals_brute_force(spark):
    check_groups(documents(spark, SF_CHECK))


def test_near_dedup_chains_hubs_and_odd_texts(spark):
    rng = np.random.default_rng(1)
    base = [f"b{i}" for i in range(200)]

    def edited(n):
        w = list(base)
        for j in rng.choice(200, n, replace=False):
            w[j] = f"e{rng.integers(1 << 30)}"
        return " ".join(w)
    texts = [(50, " ".join(base))] + [(100 + i, edited(5)) for i in range(60)]  # near the hub, not each other
    chain = [f"c{i}" for i in range(400)]
    texts += [(300 + i, " ".join(chain[10 * i:10 * i + 120])) for i in range(20)]  # each like the next
    texts += [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one"), (7, "Été"), (8, "été")]
    texts += [(400, "x " * 50000), (401, "X " * 60000)]
    check_groups(rows_of(spark, texts))
    kept = {r.doc_id for r in minhash.dedup(rows_of(spark, texts)).collect()}
    assert {50, 300, 1, 2, 3, 4, 6, 7, 8, 400} <= kept and not {5, 301, 401, 100} & kept


def test_near_dedup_repeated_ids_and_empty(spark):
    df = rows_of(spark, [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g")])
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in minhash.groups(df).collect()) == [
        (-1, -1, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert sorted(r.doc_id or -1 for r in minhash.dedup(df).collect()) == [-1, 1]
    assert minhash.groups(df.limit(0)).count() == 0 and minhash.dedup(df.limit(0)).count() == 0


def test_blocks_compare_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    check_groups(documents(spark))


def test_super_minhash_estimates_and_stops_early():
    rng = np.random.default_rng(2)
    err = []
    for _ in range(30):
        x = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        y = np.concatenate([x[:300], rng.integers(0, 1 << 63, 100).astype(np.uint64)])
        err.append((minhash.super_minhash(x) == minhash.super_minhash(y)).mean() - 0.6)
    assert abs(np.mean(err)) < 0.03 and np.std(err) < 0.06
    # in one piece or in several, in any order: the same signature
    assert (minhash.super_minhash(x) == minhash.super_minhash(rng.permutation(x))).all()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, j) for j in range(1001, 1200)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[j] == 1000 for j in range(1000, 1200))


# --- op6 ----------------------------------------------------------------------

def covered(rows, n=50):
    first, shared = {}, set()
    grams = {k: [tuple(w[i:i + n]) for i in range(len(w) - n + 1)] for k, w in rows.items()}
    for k, gs in grams.items():
        for g in gs:
            if first.setdefault(g, k) != k:
                shared.add(g)
    return {k: {j for i, g in enumerate(gs) if g in shared for j in range(i, i + n)} for k, gs in grams.items()}


def test_repeated_passages_equal_brute_force(spark):
    df = documents(spark, SF_CHECK)
    want = {k: v for k, v in covered({r.doc_id: (r.text or "").encode().split() for r in df.collect()}).items() if v}
    got = {r.doc_id: r for r in suffix_dedup.repeated_passages(df).collect()}
    assert set(got) == set(want)
    words = {k: {j for s in r.spans.split(",") for j in range(*map(int, s.split(":")))} for k, r in got.items()}
    assert all(words[k] <= want[k] and len(words[k]) == got[k].n_repeated for k in want)
    # a neighbour with the longest common start may hide a match that is longer on the left
    assert sum(map(len, words.values())) >= 0.995 * sum(map(len, want.values()))


def test_repeated_passages_odd_texts(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, "a b " + passage + " c"), (2, passage), (3, None), (4, ""), (5, "x " * 3000), (6, passage[:100]),
            (7, "y " * 100 + "z " * 100), (None, passage), (8, "same " * 5 + " ".join(f"q{i}" for i in range(80)) * 2)]
    got = {r.doc_id: r.spans for r in suffix_dedup.repeated_passages(rows_of(spark, rows)).collect()}
    assert got == {1: "2:62", 2: "0:60"}
    assert suffix_dedup.repeated_passages(rows_of(spark, rows).limit(0)).count() == 0


# --- op8 ----------------------------------------------------------------------

def test_packing_holds_every_piece_once(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    odd = [(9001, None), (9002, ""), (9003, "it's 'sat WE'LL #'s don't!!x9 é́ ÉCOLE İstanbul <|endoftext|> <|STARTOFTEXT|> a b Σας 12,34 中文 ﬁ"),
            (9004, "w" * 30000), (9005, "same"), (9005, "same")]
    df = documents(spark).union(rows_of(spark, odd)).withColumn("length", F.lit("clash"))
    got = packing.pack(df, tokenizer_path()).toPandas()
    want = []
    for r in df.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at:at + 4096], "<u4")
            want.append((r.doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(tuple, got[["doc_id", "piece", "start", "length", "ids_crc32"]].to_numpy().tolist())) == sorted(want)
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id")["length"].cumsum() - got["length"] == got["offset"]).all()
    assert got.groupby("sequence_id")["length"].sum().max() <= 4096
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 4096) * 1.01 + 1
    assert packing.pack(df.limit(0), tokenizer_path()).count() == 0


def test_plan_meets_the_lower_bound():
    rng = np.random.default_rng(4)
    n = np.minimum(rng.lognormal(6, 1, 20000).astype(int) + 1, 4095)
    lengths, counts = np.unique(n, return_counts=True)
    plan = packing.plan_bins(lengths, counts)
    held = Counter()
    for config, times in plan:
        assert sum(x * m for x, m in config) <= 4096
        for x, m in config:
            held[x] += m * times
    assert held == Counter(dict(zip(lengths.tolist(), counts.tolist())))
    assert sum(t for _, t in plan) <= 1.005 * n.sum() / 4096 + 1


# --- op9 ----------------------------------------------------------------------

def test_mixing_targets_and_copies(spark):
    rows = [(i, "w " * 50, "en", "a", 1) for i in range(400)] + [(1000 + i, "w " * 20, "en", "b", 1) for i in range(100)]
    rows += [(2000 + i, "w", "en", None, 1) for i in range(10)] + [(3000, None, "en", "empty", 0)]
    df = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash")).withColumn("target", F.lit(0))
    got = mixing.mix_plan(df).collect()
    per = {r.source: r for r in got}
    total = 400 * 50 + 100 * 20 + 10
    # weights by code point: a 5, b 2, empty 1, null 5; b, empty and null stop at three times their words
    assert per["b"].target == 6000 and per["empty"].target == 0 and per[None].target == 30
    assert per["a"].target == pytest.approx(total - 6030)
    assert all(r.taken == r.size * r.n_copies and r.taken <= 3 * r.size for r in got)
    taken = sum(r.taken for r in got if r.source == "a")
    assert abs(taken - per["a"].target) < 0.1 * per["a"].target
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_plan(df).collect()))
    assert mixing.mix(df).count() == sum(r.n_copies for r in got)
    assert mixing.mix_plan(df.limit(0)).count() == 0


# --- op10 ---------------------------------------------------------------------

def test_cotraining_held_out_accuracy(spark):
    docs, labels = documents(spark, SF_CHECK), spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    held = F.pmod(F.col("doc_id"), F.lit(3)) == 0
    got = {r.doc_id: r for r in cotrain.score(docs, labels.filter(~held), rounds=2).collect()}
    assert len(got) == docs.count()
    test = [(got[r.doc_id].kept, r.quality) for r in labels.filter(held).collect()]
    right = sum(k == (q == 1) for k, q in test) / len(test)
    clean = [k for k, q in test if q == 1]
    assert right >= 0.95 and sum(clean) / len(clean) >= 0.95


def test_cotraining_odd_tables(spark):
    docs = rows_of(spark, [(1, None), (2, ""), (None, "x"), (3, "y " * 20000), (3, "y")]).withColumn("y", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = cotrain.score(docs, none).collect()
    assert len(got) == 5 and all(r.kept and r.score is None for r in got)
    assert cotrain.score(docs.limit(0), none).count() == 0


# --- pipeline -----------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P
    from hearth.llm import host_rules
    docs = documents(spark)
    columns, at = docs.columns, {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = at[name] = spark.read.parquet(f"{tmp_path}/{name}")
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    good = {r.doc_id for r in host_rules.judge(documents(spark)).filter("kept").collect()}
    assert {r.doc_id for r in at["quality_rules"].collect()} == good
    sets = shingle_sets([(r.doc_id, r.text) for r in at["quality_rules"].collect()])
    firsts = {k for k, v in brute_components(sets).items() if k == v}
    assert {r.doc_id for r in at["near_dedup"].collect()} == firsts == {r.doc_id for r in at["secret_scan"].collect()}
    mixed = Counter(r.doc_id for r in at["source_mixing"].collect())
    assert set(mixed) <= firsts and max(mixed.values()) <= 3
    packed = Counter(r.doc_id for r in at["best_fit_packing"].filter("piece = 0").collect())
    assert packed == mixed
    assert P.run(spark, SF_SMALL).count() == at["best_fit_packing"].count()
