"""The corpus pipeline against a version without Spark, and its registration."""

import hashlib
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from terrafold.llm import tokens
from test_llm_dedup import brute_groups, brute_print
from test_llm_text import brute_hits

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet")
             .select("item_id", "text").collect()]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    # Every document of these tables is in some language.
    want = [set(rows)]
    by_text = {}
    for i in sorted(rows):
        by_text[hashlib.sha256((rows[i] or "").encode()).digest()] = i
    want.append(set(by_text.values()))
    left = sorted(want[-1])
    prints = [brute_print(rows[i]) for i in left]
    label = brute_groups([p - (1 << 64) if p >> 63 else p for p in prints])
    want.append({left[k] for k in set(label.tolist())})
    judged = brute_hits([(i, rows[i]) for i in want[-1]], items)
    want.append({i for i, _, n, _ in judged if not n})
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        path = str(tmp_path / name)
        stage(spark, now, SF).write.parquet(path)
        now = spark.read.parquet(path)
        assert now.columns == docs.columns
        assert {r["doc_id"] for r in now.select("doc_id").collect()} == want[k]
        assert now.count() == len(want[k])
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    library = Tokenizer.from_file(tokens.vocabulary_path(tokens.WORD_VOCABULARY))
    got = {}
    for r in sorted(pieces, key=lambda r: r["start"]):
        assert r["start"] == len(got.setdefault(r["doc_id"], []))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        got[r["doc_id"]] += list(r["ids"])
    assert got == {i: [*library.encode(rows[i], add_special_tokens=False).ids, 2]
                   for i in want[-1]}


def test_run_gives_the_pieces(spark):
    found = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(found.columns)
    assert found.count() > 0


def test_registered():
    names = contract.queries()
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and "pipeline" not in contract.oracle_sql()


@pytest.mark.parametrize("stage", range(4))
def test_stages_of_nothing(spark, stage):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    out = corpus_pipeline.STAGES[stage][1](spark, empty, SF)
    assert out.columns == empty.columns and out.count() == 0
