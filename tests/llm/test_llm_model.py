"""The recurrent model and document scores."""

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrafold.llm import gru, lm_scoring

DOCS = "doc_id bigint, text string"


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = gru.Network.fresh(np.ones(6) / 6, 5)
    net.X, net.U, net.W, net.b = (p.astype(np.float64) for p in net.parts())
    net.W += rng.standard_normal(net.W.shape) * 0.3
    window = (rng.standard_normal((4, 5)), rng.integers(0, 6, (7, 4)), rng.random((7, 4)) < 0.2,
              (rng.random((7, 4)) < 0.9).astype(np.float64))
    _, grads, _ = net.window(*window)
    for part, grad in zip(net.parts(), grads):
        for _ in range(15):
            i = tuple(rng.integers(0, n) for n in part.shape)
            old, losses = part[i], []
            for step in (1e-5, -1e-5):
                part[i] = old + step
                losses.append(net.window(*window)[0])
            part[i] = old
            assert grad[i] == pytest.approx((losses[0] - losses[1]) / 2e-5, abs=1e-7)


def test_windows_use_their_memory_again():
    rng = np.random.default_rng(5)
    net, space = gru.Network.fresh(np.ones(9) / 9), gru.Space()
    peaks = []
    for streams in (200, 200, 64):
        window = (np.zeros((streams, gru.STATE), np.float32), rng.integers(0, 9, (32, streams)),
                  rng.random((32, streams)) < 0.1, np.ones((32, streams), np.float32))
        alone = net.window(*window)
        tracemalloc.start()
        loss, grads, h = net.window(*window, space)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert loss == alone[0] and (h == alone[2]).all()
        assert all((a == b).all() for a, b in zip(grads, alone[1]))
    assert max(peaks[1:]) < peaks[0] / 4


def test_neighbours_are_counted_within_reach_and_within_texts():
    head = lm_scoring.Head([b"w%d" % i for i in range(120)], np.ones(120, np.int64), 1, 1, 1)
    rng = np.random.default_rng(2)
    texts = [rng.integers(-3, 120, n).astype(np.int32) for n in (40, 0, 1, 3, 25)]
    seen = np.zeros(120 * lm_scoring.CONTEXT, np.int64)
    lm_scoring.add_neighbours(seen, texts, head)
    want = Counter((int(t[i]), int(t[j])) for t in texts for i in range(len(t)) for j in range(len(t))
                   if 0 < abs(i - j) <= lm_scoring.REACH and t[i] >= 0 and 0 <= t[j] < lm_scoring.CONTEXT)
    found = {(int(k) // lm_scoring.CONTEXT, int(k) % lm_scoring.CONTEXT): int(seen[k])
             for k in np.flatnonzero(seen)}
    assert found == dict(want)


def test_words_read_together_are_those_of_each_text():
    texts = ["the Cat", "", None, " \t", "\x0bÜber\x1c cat\u00a0dog \n", "of of THE ab \x85 z"] * 3
    column = pa.array([t or "" for t in texts]).slice(1)
    words, ends = lm_scoring.flat_words(column)
    want = [lm_scoring.words_of((t or "").encode()) for t in texts[1:]]
    assert [words[a:b].to_pylist() for a, b in zip(ends, ends[1:])] == want
    for top in ([], [b"the", b"of"], sorted({w for t in want for w in t})):
        head = lm_scoring.Head(top, np.ones(len(top), np.int64), 1, 1, 1)
        for some in (words, words.slice(2, 5), words.slice(0, 0)):
            assert head.read(some).tolist() == lm_scoring.read_row(some.to_pylist(), head).tolist()


def test_counts_are_added_up_before_they_are_handed_on(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(f"W{rng.randrange(40)}" for _ in range(30)) for _ in range(50)]
    docs = spark.createDataFrame(enumerate([*texts, None, ""]), DOCS).repartition(1)
    monkeypatch.setattr(lm_scoring, "SLICE", 200)
    want = Counter(w for t in texts for w in t.lower().encode().split())
    for most in (5, 1000):
        monkeypatch.setattr(lm_scoring, "COUNTED", most)
        assert {bytes(r["word"]): r["c"] for r in lm_scoring.word_counts(docs).collect()} == want


def test_large_weights_overflow_nothing():
    rng = np.random.default_rng(6)
    net = gru.Network.fresh(np.ones(7) / 7)
    texts = [rng.integers(0, 7, 50)]
    usual = net.score(texts)
    net.b += 500  # the same shares
    assert net.score(texts) == pytest.approx(usual, rel=1e-4)


def test_scores_carry_the_state_through_whole_texts(monkeypatch):
    rng = np.random.default_rng(3)
    net = gru.Network.fresh(np.ones(5) / 5, 6)
    net.W += rng.standard_normal(net.W.shape).astype(np.float32)
    texts = [rng.integers(0, 5, n) for n in (1, 90, 33, 0, 32, 7, 400)]
    want = []
    for text in texts:  # one token after the other
        h, total = np.zeros((1, 6), np.float32), 0.0
        for c in text:
            total += float(gru._log_softmax(h @ net.W + net.b)[0, c])
            h, _ = net.step(h, np.array([c]))
        want.append(total)
    assert net.score(texts) == pytest.approx(want, rel=1e-4, abs=1e-5)
    monkeypatch.setattr(gru, "SIDE_BY_SIDE", 2)
    assert net.score(texts) == pytest.approx(want, rel=1e-4, abs=1e-5)
    assert net.score([]).tolist() == []


def test_training_learns_an_order():
    texts = [np.array([1, 2, 3, 4] * 20 + [0]) for _ in range(40)]
    net = gru.Network.fresh(np.ones(5) / 5, 12)
    losses = net.train(texts, epochs=6, streams=8)
    assert losses[-1] < 0.3 * losses[0]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    vocabulary = ["the", "cat", "dog", "Sat", "on", "über", *[f"r{i}" for i in range(60)]]
    out = [(i, " ".join(rng.choice(vocabulary[:8] * 5 + vocabulary)
                        for _ in range(rng.randrange(1, 40)))) for i in range(120)]
    return out + [(None, "the cat"), (500, None), (501, ""), (502, "new words only"),
                  (3, "the\x0bdog"), (3, "the\x0bdog"), (503, "the " * 5000)]


@pytest.mark.parametrize("head", [100_000, 4])
def test_scores(spark, rows, head):
    docs = spark.createDataFrame(rows, DOCS).withColumn("word", F.lit("clash")).repartition(3)
    learned = lm_scoring.fold() != lm_scoring.HELD_OUT
    found = lm_scoring.scores(docs, docs.where(learned), head_words=head)
    count, ends = Counter(), 0
    for i, t in rows:
        if zlib.crc32(str(i or 0).encode()) % 7 != 2:
            count.update((t or "").encode().lower().split())
            ends += 1
    n, kinds = sum(count.values()) + ends, len(count) + 1
    want = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        base = sum(math.log10((c + 1) / (n + kinds + 1)) for c in [*(count[x] for x in w), ends])
        want.append((str(i), len(w) + 1, sum(count[x] > 0 for x in w) + 1, n, round(base, 6)))
    got = found.collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 6)) for r in got) == sorted(want)
    assert all(r["score"] < 0 for r in got)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_learning_from_nothing(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    none = lm_scoring.scores(docs, docs.limit(0)).collect()
    assert len(none) == len(rows)
    assert {(r["base_score"], r["score"], r["n_known"]) for r in none} == {(0.0, 0.0, 0)}
    assert lm_scoring.scores(docs.limit(0), docs).collect() == []


def test_word_probabilities_sum_to_one(rows):
    """Classes share out all probability, with one place for what was never seen."""
    count = Counter(w for _, t in rows for w in (t or "").encode().lower().split())
    top = [w for w, c in count.most_common(10)]
    head = lm_scoring.Head(top, np.array([count[w] for w in top]), 5, 1000, 90)
    texts = [head.ids((t or "").encode().lower().split()) for _, t in rows]
    classes = lm_scoring.learn_classes(texts, head, 3)
    inside = np.bincount(classes.of_head, head.counts, minlength=4)
    for k in range(1, 4):
        members = [c for c, own in zip(head.counts, classes.of_head) if own == k]
        assert not members or sum(members) == inside[k]
    assert set(classes.of_head.tolist()) <= {1, 2, 3}
    assert all(classes.rare(w) in (4, 5, 6) for w in count)


def test_long_documents_train_the_network(spark):
    docs = spark.createDataFrame([(i, "a b c d " * 8000) for i in range(16)], DOCS).repartition(3)
    for r in lm_scoring.scores(docs, docs).collect():
        assert r["base_score"] / r["n_tokens"] < -0.55
        assert r["score"] / r["n_tokens"] > -0.2


def test_neighbours_and_lines_are_of_all_documents(spark, rows, monkeypatch):
    count = Counter(w for _, t in rows for w in (t or "").encode().lower().split())
    top = [w for w, c in count.most_common(30)]
    head = lm_scoring.Head(top, np.array([count[w] for w in top]), 5, 1000, 90)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    want = Counter()
    for _, t in rows:
        ids = head.ids((t or "").encode().lower().split()).tolist()
        want.update((a, b) for i, a in enumerate(ids) if a >= 0
                    for j, b in enumerate(ids[max(0, i - 4):i + 5], max(0, i - 4))
                    if i != j and b >= 0)
    seen = lm_scoring.neighbours(docs, head).reshape(30, 30)
    assert {(a, b): int(seen[a, b]) for a, b in zip(*np.nonzero(seen))} == want
    classes = lm_scoring.cluster(seen.ravel(), head)
    lines = lm_scoring._lines(docs, head, classes)
    got = sorted(bytes(r["line"]) for r in lines.collect())
    texts = [(t or "").encode().lower().split() for _, t in rows]
    assert got == sorted(lm_scoring.class_row(w, head.ids(w), classes).astype(np.uint8).tobytes()
                         for w in texts)
    # With a share a round, every line is learned from once.
    monkeypatch.setattr(lm_scoring, "FEW", 0)
    read, one = [], lm_scoring._round
    monkeypatch.setattr(lm_scoring, "_round", lambda some, *more: (
        read.extend(bytes(r["line"]) for r in some.collect()), one(some, *more))[1])
    n = sum(map(len, got))
    fresh = gru.Network.fresh(np.ones(1 + 2 * classes.most) / (1 + 2 * classes.most))
    net = lm_scoring.trained(lines, fresh, n)
    assert sorted(read) == got
    numbers = [np.frombuffer(x, np.uint8) for x in got]
    assert net.score(numbers).sum() > fresh.score(numbers).sum()


def test_training_reads_by_one_rule_whatever_the_size(spark, monkeypatch):
    lines = spark.createDataFrame([(bytes([k, k]), k % lm_scoring.TURNS) for k in range(8)],
                                  "line binary, share int")
    read = []
    monkeypatch.setattr(lm_scoring, "_round", lambda some, net, *_: (
        read.append(sorted(bytes(r["line"]) for r in some.collect())), net)[1])
    small, large = [], []
    for tokens, kept in ((16, small), (1 << 40, large)):
        read.clear()
        lm_scoring.trained(lines, None, tokens)
        kept.extend(read)
    assert small == large
