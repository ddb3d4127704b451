"""Operators 11 to 13 against brute force, on hostile rows too."""

import hashlib
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.llm import exact_dedup, filter_audit, merkle
from hearth.llm.skew import join_groups
from hearth.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def hostile(n=3000):
    """Nulls in every column, empty and very long texts, repeated ids and rows, one hot text, more than one block."""
    rows = []
    for k in range(n):
        text = [None, "", "  \n\t", "same text here\n", "Same # TEXT", f"word{k} " * (k % 90), f"line {k}\nline {k + 1}\n\n"][k % 7]
        if k % 3 == 0:
            text = "the hot text of a third of all rows\n" + " " * (k % 2)
        rows.append((None if k % 101 == 0 else k % 2900, text, None if k % 5 == 0 else "en",
                     [None, "", "hot", "hot", "hot", "ü", f"s{k % 40}"][k % 7], None if k % 11 == 0 else k))
    rows += rows[:40]
    rows.append((10**9, "long passage of words " * 60000, "de", "hot", 7))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    extra = {c: F.lit(k) for k, c in enumerate(("row", "digest", "id", "chars", "grp", "pos", "hash", "part", "block", "best"))}
    return spark.createDataFrame(hostile(), SCHEMA).repartition(7).withColumns(extra)


def rows_of(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


# ---------------------------------------------------------------- 11

def brute_copies(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        t = text or ""
        groups[hashlib.sha256(t.translate({ord(c): None for c in " \t\n\x0b\x0c\r"}).encode()).hexdigest()].append((doc_id, len(t)))
    out = Counter()
    for h, g in groups.items():
        order = sorted(g, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        for k, (doc_id, _) in enumerate(order):
            out[(doc_id, order[0][0], len(g), k == 0, h)] += 1
    return out


COPIES = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("deliveries", [1, 3])
def test_copies_equal_brute_force_however_delivered(docs, deliveries):
    assert rows_of(exact_dedup.audit(docs, deliveries, buckets=5), *COPIES) == brute_copies(hostile())


def test_index_persists_and_passes_only_new_texts(spark):
    path = scratch_path(spark, "index-test")
    exact_dedup.DigestIndex.create(spark, path, buckets=4)

    def deliver(name, rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string, digest string")  # a clashing column
        new = exact_dedup.new_documents(exact_dedup.DigestIndex.open(spark, path), docs, name)
        assert new.columns == docs.columns
        return sorted(tuple(r) for r in new.collect())

    first = [(1, "a b", "x"), (2, "ab ", "y"), (3, "ab", "z"), (4, None, "w"), (5, "c", None)]
    assert deliver("d1", first) == [(1, "a b", "x"), (4, None, "w"), (5, "c", None)]
    assert deliver("d2", [(6, "a  b  ", "x"), (7, "d", "x"), (8, "", "x")]) == [(7, "d", "x")]
    assert deliver("d1", first) == [(1, "a b", "x"), (4, None, "w"), (5, "c", None)]  # run again: nothing is added
    assert deliver("d3", []) == []
    index = exact_dedup.DigestIndex.open(spark, path)
    sizes = Counter(r["group_size"] for r in index.groups().collect())
    assert sizes == {4: 1, 2: 1, 1: 2}
    small = index.compact(scratch_path(spark, "index-compact"))
    assert small.groups().count() == 4 and small._entries().count() == 4
    assert rows_of(small.groups(), "digest", "group_size") == rows_of(index.groups(), "digest", "group_size")


def test_anti_join_reads_the_index_by_bucket(spark):
    index = exact_dedup.DigestIndex.create(spark, scratch_path(spark, "index-plan"), buckets=16)
    index.ingest(exact_dedup.keyed(spark.createDataFrame([(1, "a")], "doc_id long, text string")), "d")
    known = index._entries().select("digest").hint("merge")
    plan = known.groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert exact_dedup.audit(empty).count() == 0
    assert filter_audit.interactions(empty, labels).count() == 0
    assert merkle.manifest(empty, merkle.newlines_removed()).count() == 0


def test_join_groups_equals_a_plain_join(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1700).alias("k"))
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("m"))
    assert rows_of(join_groups(rows, groups, "k", "n"), "id", "k", "n", "m") == rows_of(rows.join(groups, "k"), "id", "k", "n", "m")


# ---------------------------------------------------------------- 12

def brute_audit(rows, labels):
    least = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    good, toxic = ({d for d, *l in labels if d is not None and l[k] == 1} for k in (0, 1))
    fails = defaultdict(list)
    for doc_id, text, _, source, _ in rows:
        t = text or ""
        w = t.translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ")
        w = [x for x in w if x]
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
             "D": any(c in "#$%&*|" for c in t), "E": doc_id is not None and doc_id > least[t]}
        fails[source or ""].append(({k for k, v in f.items() if v}, doc_id in good, doc_id in toxic))
    out, shapley = {}, Counter()
    for part, docs in fails.items():
        for order in permutations("ABCDE"):
            before = set()
            for step, f in enumerate(order, 1):
                mine = [x for x in docs if f in x[0]]
                gone = [x for x in mine if not x[0] & before]
                before.add(f)
                out[(part, "".join(order), step)] = [
                    sum(not x[0] & before for x in docs), len(gone), len(mine) - len(gone), sum(x[0] == {f} for x in docs),
                    sum(x[1] for x in gone), sum(x[2] for x in gone)]
                shapley[part, f] += len(gone)
    return Counter((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_audit_equals_brute_force(spark, docs, monkeypatch):
    labels = [(k, [0, 1, None][k % 3], [1, None, 0, 0][k % 4]) for k in range(0, 2900, 3)] + [(None, 1, 1), (5, 1, 1), (5, 0, 0)]
    monkeypatch.setattr(filter_audit, "BLOCK", 64)  # many blocks a part
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x"))
    got = rows_of(filter_audit.interactions(docs, lab), *AUDIT)
    want = brute_audit(hostile(), labels)
    assert got == want and len(want) == 600 * len({r[3] or "" for r in hostile()})


def test_galloping_merges():
    rng = np.random.default_rng(3)
    for _ in range(300):
        lists = [np.unique(rng.integers(0, rng.integers(1, 60), rng.integers(0, 40))) for _ in range(rng.integers(0, 6))]
        union = filter_audit.gallop_union(lists)
        assert union.tolist() == sorted(set().union(*(x.tolist() for x in lists)))
        for x in lists:
            assert filter_audit.gallop_difference(union, x).tolist() == sorted(set(union.tolist()) - set(x.tolist()))
            assert len(filter_audit.gallop_difference(x, union)) == 0


def test_posting_lists_are_bounded_and_sorted(spark):
    rows = spark.range(200_000).select(F.col("id").alias("row"), F.lit("hot").alias("part"),
                                       *[(F.col("id") % k == 0).alias(f) for k, f in zip((2, 3, 5, 7, 11), "ABCDE")],
                                       F.lit(True).alias("good"), F.lit(False).alias("toxic"))
    lists = filter_audit.posting_lists(rows)
    assert lists.agg(F.max(F.size("ids"))).first()[0] == filter_audit.BLOCK
    assert lists.filter(F.col("ids") != F.array_sort("ids")).isEmpty()
    total = lists.filter("list = 'C'").agg(F.sum(F.size("ids"))).first()[0]
    assert total == 40_000


# ---------------------------------------------------------------- 13

def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, text):
    return sha("".join(field(x) for x in (r[0], r[3], r[2], r[4], text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, i):
    out = []
    for level in tree[:-1]:
        r = i - i % 3
        out.append(("".join(level[r:i]), "".join(level[i + 1:r + 3])))
        i //= 3
    return out


def brute_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
    trees = {s: levels([leaf_of(r, r[1]) for r in groups[s]]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    root = top[-1][0]
    out = Counter()
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            path = siblings(trees[s], i) + siblings(top, k)
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            h = leaf_of(r, text)
            for left, right in path:
                h = sha(left + h + right)
            out[(r[0], leaf_of(r, r[1]), trees[s][-1][0], root, sha("".join(a + b for a, b in path)), h, h == root)] += 1
    return out


MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("block_levels", [1, 6])
def test_manifest_equals_brute_force(docs, monkeypatch, block_levels):
    monkeypatch.setattr(merkle, "LEVELS", block_levels)  # 1: many rounds; 6: as in production
    few = docs.filter("doc_id % 5 = 0 or doc_id is null") if block_levels == 1 else docs
    rows = [tuple(r) for r in few.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = rows_of(merkle.manifest(few, merkle.newlines_removed()), *MANIFEST)
    assert got == brute_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_trees_of_every_shape(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    rows = [(k, f"t{k}\n", "en", "one", k) for k in range(n)]
    got = rows_of(merkle.manifest(spark.createDataFrame(rows, SCHEMA), merkle.newlines_removed()), *MANIFEST)
    assert got == brute_manifest(rows)


def test_a_changed_field_changes_the_root(spark):
    rows = hostile(60)
    root = {r[0] for r in rows_of(merkle.manifest(spark.createDataFrame(rows, SCHEMA)), "root")}
    assert len(root) == 1
    for c, v in ((0, 12345), (1, "other"), (2, "xx"), (3, "zz"), (4, 99)):
        changed = list(rows)
        changed[7] = tuple(v if k == c else x for k, x in enumerate(rows[7]))
        assert {r[0] for r in rows_of(merkle.manifest(spark.createDataFrame(changed, SCHEMA)), "root")} != root
