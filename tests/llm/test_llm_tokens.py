"""Token counts, the token store and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terrafold.llm import packing, token_counts, token_store, tokens
from terrafold.workspace import new_path

DOCS = "doc_id bigint, source string, text string"
WORDS = ["the", "Strauß", "naïve", "don't", "we'll", "x1y22", "!!!", "a.b", "日本語", "ΑΣ", " ",
         "<|endoftext|>", "<|EndOfText|>", "é", "\x1c", "…", "end.", "İ", "'s", "🙂", "٣"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.vocabulary_path(tokens.WORD_VOCABULARY))


def noisy(rng, n):
    return "".join(rng.choice(WORDS) + rng.choice(["", " ", "  ", "\n", "\t", " "])
                   for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [(i, f"s{rng.choice([0, 0, 0, 1, 2])}", noisy(rng, rng.randrange(60)))
           for i in range(60)]
    return out + [(None, None, "no id"), (70, None, None), (71, "s1", ""), (71, "s1", ""),
                  (72, "s2", "aaaa" * 3000), (73, "s0", noisy(rng, 4000)), (3, "s0", "again")]


def ids_of(library, text, end):
    return [*library.encode(text or "", add_special_tokens=False).ids, end]


def test_encoder_and_transducer_equal_the_library(library):
    rng = random.Random(9)
    texts = [noisy(rng, 80) for _ in range(60)] + ["", " ", "a" * 700, "ab" * 400 + "?!" * 90]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0x250), rng.randrange(0x250, 0xD800),
                                      rng.randrange(0xE000, 0x20000)])) for _ in range(40))
              for _ in range(150)]
    raw = [t.encode() for t in texts]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    few = tokens.Encoder(tokens.WORD_VOCABULARY, most=300)  # forgets again and again
    got = [b for r in raw for b in few.encode([r])]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    counter = token_counts.Counter(tokens.WORD_VOCABULARY, most=300)
    counter.machine.most_states = 500
    assert [counter.count([r])[0] for r in raw] == [len(w) for w in want]


def test_pairs_that_stay_apart_are_those_the_merges_leave():
    machine, rng = token_counts.counter(tokens.WORD_VOCABULARY).machine, random.Random(2)
    inner = [t for t, s in machine.symbols.items() if all(x < 256 for x in s)]
    for _ in range(3000):
        a, b = rng.choice(inner), rng.choice(inner)
        row = machine._merged(machine.symbols[a] + machine.symbols[b])
        assert machine._stay_apart(a, b) == (row == [a, b])


def test_state_maps_compose_in_any_grouping(library):
    tool, rng = token_counts.counter(tokens.WORD_VOCABULARY), random.Random(4)
    for _ in range(60):
        text = noisy(rng, 40).encode().decode("utf-8")
        cuts = sorted(rng.randrange(len(text) + 1) for _ in range(9))
        parts = [text[a:b].encode() for a, b in zip([0, *cuts], [*cuts, len(text)])]
        maps = [token_counts.state_map(p, tool) for p in parts]
        while len(maps) > 1:
            k = rng.randrange(len(maps) - 1)
            n = rng.randrange(2, 4)
            maps[k:k + n] = [token_counts.compose(maps[k:k + n], tool)]
        assert token_counts.closed(maps[0], tool) == len(
            library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("chunk,fan", [(1 << 15, 64), (50, 3)])
def test_counts(spark, library, rows, chunk, fan):
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_tokens", F.lit("clash"))
    got = token_counts.counts(docs, chunk_chars=chunk, fan=fan).collect()
    want = [(i, len((t or "").encode()), len(ids_of(library, t, 0)) - 1) for i, _, t in rows]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_counts_of_nothing(spark):
    assert token_counts.counts(spark.createDataFrame([], DOCS)).collect() == []


def test_store_round_trip(spark, library, rows):
    path = new_path(spark, "store")
    token_store.write_tokens(spark.createDataFrame(rows, DOCS).repartition(5), path)
    read = token_store.read_tokens(spark, path)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], list(r["ids"])) for r in read.collect())
    at = 0
    for start, _, n, ids in got:
        assert start == at and n == len(ids) and ids[-1] == token_store.END_ID
        at += n
    order = [i for _, i, _, _ in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    want = [(str(i), ids_of(library, t, 1)) for i, _, t in rows]
    assert sorted((str(i), ids) for _, i, _, ids in got) == sorted(want)
    sums = token_store.checked(read, ["doc_id", "start"]).collect()
    by_start = {s: ids for s, _, _, ids in got}
    assert all(r["ids_crc32"] == zlib.crc32(np.array(by_start[r["start"]], "<u4").tobytes())
               for r in sums)


def test_store_layout_and_selective_reads(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_tokens(spark.createDataFrame(rows, DOCS), path)
    file = next(f for f in sorted((tmp_path / "store").glob("*.parquet"))
                if pq.ParquetFile(f).metadata.num_rows)
    meta = pq.ParquetFile(file).metadata.row_group(0)
    columns = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    ids = next(c for n, c in columns.items() if n.startswith("ids"))
    assert "RLE_DICTIONARY" in ids.encodings
    assert "DELTA_BINARY_PACKED" in columns["n_tokens"].encodings
    assert ids.has_offset_index and columns["doc_id"].has_column_index
    few = token_store.read_tokens(spark, path).where("doc_id between 10 and 12")
    plan = few.select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,10)" in plan
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scans and not any("ids" in line.split("ReadSchema")[1] for line in scans)
    assert sorted(r["doc_id"] for r in few.collect()) == [10, 11, 12]


def test_store_of_nothing(spark):
    path = new_path(spark, "store")
    token_store.write_tokens(spark.createDataFrame([], DOCS), path)
    assert token_store.read_tokens(spark, path).collect() == []


def check_pieces(rows, found, library, length):
    """Every id in one piece, windows gapless and full but the last."""
    windows, docs = {}, {}
    for r in found:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs.setdefault(r["doc_id"], []).append(r)
        assert r["length"] == len(r["ids"]) > 0
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    assert sorted(windows) == list(range(len(windows)))
    for w, parts in windows.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == length or (w == len(windows) - 1 and at < length)
    want = {}
    for i, _, t in rows:
        want.setdefault(i, []).extend(ids_of(library, t, packing.END_ID))
    assert set(want) == set(docs)
    for i, ids in want.items():
        assert sorted(x for r in docs[i] for x in r["ids"]) == sorted(ids)
        if sum(1 for r in rows if r[0] == i) == 1:
            line = sorted(docs[i], key=lambda r: r["start"])
            assert [x for r in line for x in r["ids"]] == ids
            assert all(r["doc_tokens"] == len(ids) for r in line)


@pytest.mark.parametrize("queues", [1000, 1])
def test_packing_is_whole(spark, library, rows, queues):
    docs = spark.createDataFrame(rows, DOCS).withColumn("queue", F.lit(0)).repartition(4)
    for quantum in (packing.QUANTUM, 8, 1):
        found = packing.pack(docs, length=64, queues=queues, quantum=quantum).collect()
        check_pieces(rows, found, library, 64)


def test_windows_keep_the_mixture(spark, rows):
    found = packing.pack(spark.createDataFrame(rows, DOCS), length=64, quantum=1).collect()
    total = sum(r["length"] for r in found)
    of = {}
    for r in found:
        of.setdefault(r["source_queue"], []).append((r["sequence_id"], r["length"]))
    for parts in of.values():
        share, held = sum(n for _, n in parts) / total, 0
        for w in range(total // 64):
            held += sum(n for k, n in parts if k == w)
            # The deficit carried out of any window stays within a few tokens.
            assert abs(held - share * 64 * (w + 1)) < 4


def test_targets_hold_until_a_source_runs_out(spark, rows):
    found = packing.pack(spark.createDataFrame(rows, DOCS), length=64, quantum=4,
                         shares={"s1": 0.5}).collect()
    first = [r for r in found if r["sequence_id"] == 0 and r["source_queue"] == "=s1"]
    assert sum(r["length"] for r in first) == 32


def test_packing_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], DOCS)).collect() == []


def test_deal_keeps_totals():
    rng = np.random.default_rng(1)
    for _ in range(50):
        totals = rng.integers(0, 500, rng.integers(1, 30))
        sizes, left = [], int(totals.sum())
        while left > 0:
            sizes.append(min(left, int(rng.integers(1, 90))))
            left -= sizes[-1]
        dealt = packing.deal(totals, sizes or [0])
        assert (dealt >= 0).all() and (dealt.sum(axis=0) == totals).all()
        assert dealt.sum(axis=1).tolist() == (sizes or [0])


def test_small_sources_are_mixed_too(spark, library):
    """150 sources beside one queue of their own: every window draws on many of them."""
    texts = [(i, f"s{i % 150:03}", "word " * 40) for i in range(600)]
    docs = spark.createDataFrame([(-1, "big", "word " * 9000), *texts], DOCS).repartition(3)
    found = packing.pack(docs, length=512, queues=1, quantum=1).collect()
    windows, places, got = {}, set(), {}
    for r in found:
        if r["source_queue"] != "=big":
            windows.setdefault(r["sequence_id"], set()).add(r["source_queue"])
        places |= {(r["sequence_id"], r["offset"] + k) for k in range(r["length"])}
    n = sum(r["length"] for r in found)
    assert places == {divmod(k, 512) for k in range(n)}
    assert min(len(windows[w]) for w in range(n // 512)) >= 15
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == len(got.setdefault(r["doc_id"], []))
        got[r["doc_id"]] += r["ids"]
    assert got == {i: ids_of(library, t, packing.END_ID) for i, _, t in docs.collect()}


def test_shares_of_small_sources_count(spark):
    docs = spark.createDataFrame([(1, "a", "word " * 3000), (2, "b", "word " * 2000),
                                  (3, "c", "word " * 500)], DOCS)
    found = packing.pack(docs, length=100, shares={"c": 0.5}, queues=1, quantum=1).collect()
    first = [r for r in found if r["sequence_id"] < 5 and r["source_queue"] == "=c"]
    assert 240 <= sum(r["length"] for r in first) <= 260


@pytest.mark.parametrize("sources", [20, 1000, 5000])
def test_documents_are_not_cut_into_crumbs(spark, sources):
    """Pieces a document, gapless windows, and shares, whatever the number of sources."""
    each = max(2, 6000 // sources)
    docs = spark.range(sources * each).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.pmod("id", F.lit(sources))).alias("source"),
        F.repeat(F.lit("word "), F.when(F.col("id") % 7 == 0, 900).otherwise(300)).alias("text"))
    found = packing.pack(docs.repartition(5)).drop("ids").collect()
    pieces, length, windows = {}, {}, {}
    for r in found:
        pieces[r["doc_id"]] = pieces.get(r["doc_id"], 0) + 1
        length[r["doc_id"]] = r["doc_tokens"]
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["source_queue"]))
    assert len(pieces) == sources * each
    assert all(n <= 2 + -(-length[i] // packing.QUANTUM) for i, n in pieces.items())
    for w, parts in windows.items():
        ends = [(a, a + n) for a, n, _ in sorted(parts)]
        assert ends[0][0] == 0 and all(p[1] == q[0] for p, q in zip(ends, ends[1:]))
        assert ends[-1][1] == packing.LENGTH or w == len(windows) - 1
    if sources == 20:  # every source within a quantum or two of its share, window after window
        total, held = sum(length.values()), {}
        whole = total // packing.LENGTH - 20 * packing.QUANTUM // packing.LENGTH - 1
        share = {}
        for parts in windows.values():
            for _, n, q in parts:
                share[q] = share.get(q, 0) + n / total
        for w in range(whole):
            for _, n, q in windows[w]:
                held[q] = held.get(q, 0) + n
            assert all(abs(held.get(q, 0) - s * packing.LENGTH * (w + 1)) < 3 * packing.QUANTUM
                       for q, s in share.items())


def test_what_comes_again_is_remembered(monkeypatch):
    learned = []

    class Tool(tokens.Remembered):
        def learn(self, run):
            learned.append(run)
            return run

    tool = Tool(most=3 * (tokens.PLACE_BYTES + 20))
    for _ in range(3):
        assert tool[b"common"] == b"common"
    assert learned == [b"common"] * 2  # a place from the second meeting on
    for i in range(200):
        tool[b"rare %d" % i]
        tool[b"rare %d" % i]
        tool[b"common"]
        tool.trim()
        assert tool.held <= tool.most + 3 * tokens.PLACE_BYTES
        assert len(tool) + len(tool.old) <= 10
    assert learned.count(b"common") == 2  # it returns from the old generation each time
