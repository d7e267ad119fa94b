"""Exact dedup and SimHash near-dedup against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from terrafold.llm import common, exact_dedup, simhash
from terrafold.llm.components import components

DOCS = "doc_id bigint, text string"


def brute_exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha, kept = hashlib.sha256(text.encode()).hexdigest(), False
        for i in ids:
            out.append((i, sha, keep, len(ids), i == keep and not kept))
            kept = kept or i == keep
    return sorted(out, key=str)


def exact(spark, rows):
    found = exact_dedup.decide(spark.createDataFrame(rows, DOCS)).collect()
    return sorted(((r["doc_id"], bytes(r["digest"]).hex(), r["keep_id"], r["group_size"],
                    r["kept"]) for r in found), key=str)


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(3)
    rows = [(i, f"text {rng.randrange(40)}") for i in range(150)]
    rows += [(None, "text 3"), (None, "alone"), (None, "alone"), (900, None), (901, ""),
             (7, "again"), (7, "again"), (7, "again"), (5, "again"), (950, "x" * 200_000),
             (951, "x" * 200_000)]
    return rows + [(i, "hot") for i in range(1000, 1100)] + [(1099, "hot")]


@pytest.mark.parametrize("share", [4, 1024])
def test_exact_matches_brute_force(spark, mixed, monkeypatch, share):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", share)
    assert exact(spark, mixed) == brute_exact(mixed)


def test_exact_of_nothing(spark):
    assert exact(spark, []) == []
    assert exact_dedup.keep_one(spark.createDataFrame([], DOCS)).collect() == []


def test_keep_one_returns_whole_rows(spark, mixed):
    docs = spark.createDataFrame(mixed, DOCS).withColumns(
        {c: F.lit(c) for c in ("digest", "id", "row", "keep_id", "kept")})
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    want = sorted((str(r[0]), r[1]) for r in brute_exact(mixed) if r[4])
    got = sorted((str(r["doc_id"]), hashlib.sha256((r["text"] or "").encode()).hexdigest())
                 for r in kept.collect())
    assert got == want


def brute_print(text, k=3):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \t ", "one", "One two", "a b c", "A\x0bb\x0cc  d e f",
                                  "É é " * 50, "w " * 70_000])
def test_fingerprint(text):
    assert simhash.fingerprint_of(text.encode()) % (1 << 64) == brute_print(text)


def test_fingerprint_counts_in_parts(monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(1000)).encode()
    whole = simhash.fingerprint_of(text)
    monkeypatch.setattr(simhash, "COUNTED", 7)
    assert simhash.fingerprint_of(text) == whole


def brute_groups(prints):
    fp = np.array(prints, np.int64).astype(np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= simhash.MAX_BITS
    label = np.arange(len(fp))
    while True:
        lower = np.where(near, label[None, :], len(fp)).min(axis=1)
        if (lower == label).all():
            return label
        label = lower


def groups_of(nodes, pairs):
    """The smallest node of each node's component."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n
    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("crowd", [1, 3, 64])
def test_links_join_exactly_the_near_ones(spark, crowd):
    rng, prints = random.Random(crowd), set()
    for _ in range(30):
        fp = rng.getrandbits(64)
        for _ in range(12):
            prints.add(fp)
            fp ^= sum(1 << rng.randrange(64) for _ in range(rng.choice([1, 1, 2, 3])))
            fp &= (1 << 64) - 1
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in prints)
    found = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), crowd)
    pairs = {(r["a"], r["b"]) for r in found.collect()}
    label = brute_groups(signed)
    got = groups_of(signed, pairs)
    for i, f in enumerate(signed):
        assert got[f] == min(signed[j] for j in range(len(signed)) if label[j] == label[i])
    if crowd == 64:  # nothing crowded: every single link is listed
        near = {(a, b) for a in signed for b in signed
                if a < b and bin((a ^ b) % (1 << 64)).count("1") <= 2}
        assert {tuple(sorted(p)) for p in pairs} == near


@pytest.mark.parametrize("share", [2, 1024])
def test_components(spark, monkeypatch, share):
    monkeypatch.setattr(common, "HOT_SHARE", share)
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)]
    rng.shuffle(edges)
    found = components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert {r["node"]: r["root"] for r in found} == groups_of(nodes, edges)
    assert len(found) == len(nodes)


def test_near_groups_with_odd_rows(spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(5, base), (9, base), (3, base + " end"), (None, base), (20, ""), (21, None),
            (22, "alone is short"), (22, "alone is short"), (None, "nameless text here")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit(1)).withColumn("root", F.lit(2))
    found = simhash.near_groups(docs).collect()
    assert len(found) == len(rows)
    got = {(r["doc_id"], r["component_id"]) for r in found}
    prints = [brute_print(t) for _, t in rows]
    label = brute_groups([p - (1 << 64) if p >> 63 else p for p in prints])
    for (doc_id, _), mine in zip(rows, label):
        ids = [r[0] for r, o in zip(rows, label) if o == mine and r[0] is not None]
        assert (doc_id, min(ids) if ids else None) in got
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {20, 22, None}
    assert simhash.keep_one(docs.limit(0)).collect() == []


def test_join_spread_equals_a_plain_join(spark, monkeypatch):
    many = spark.createDataFrame([(i, 0 if i % 3 else i) for i in range(300)], "i int, k int")
    one = many.groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("top")).where("k < 250")
    plain = sorted(tuple(r) for r in many.join(one.drop("n"), "k", "left").collect())
    for share in (2, 1024):
        monkeypatch.setattr(common, "HOT_SHARE", share)
        got = common.join_spread(many, one, "k", "n")
        assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(plain, key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_go_by_shuffles_whatever_size_spark_takes_them_for(spark, monkeypatch):
    # A row of a few bytes is exploded into 34 probes; the file's size does not tell.
    prints = spark.createDataFrame([(i * i * 7919,) for i in range(200)], "fp bigint")
    found = simhash.links(prints, 1)
    assert "SortMergeJoin" in plan_of(found)
    assert "BroadcastHashJoin" not in plan_of(found)
    many = spark.createDataFrame([(i, i % 40) for i in range(80)], "i int, k int")
    one = many.groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("top"))
    monkeypatch.setattr(common, "HOT_SHARE", 2)  # no key is hot
    for how in ("left", "inner"):
        assert "BroadcastHashJoin" not in plan_of(common.join_spread(many, one, "k", "n", how))
