"""The registered queries of this subpackage, by name, and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from terrafold.llm import (
    chat,
    decontaminate,
    exact_dedup,
    filter_audit,
    hard_negatives,
    language_id,
    lm_scoring,
    packing,
    secret_scan,
    simhash,
    token_counts,
    token_store,
    warc,
)
from terrafold.llm.common import prepare

_QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_chat": chat.op2_chat,
    "op3_warc": warc.op3_warc,
    "op4_packing": packing.op4_packing,
    "op5_language_id": language_id.op5_language_id,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_token_store": token_store.op7_token_store,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_simhash": simhash.op9_simhash,
    "op10_lm_score": lm_scoring.op10_lm_score,
    "op11_secret_scan": secret_scan.op11_secret_scan,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}
_ORACLES = {
    "op1_decontaminate": decontaminate.OP1_SQL,
    "op3_warc": warc.OP3_SQL,
    "op6_exact_dedup": exact_dedup.OP6_SQL,
    "op11_secret_scan": secret_scan.OP11_SQL,
    "op12_hard_negatives": hard_negatives.OP12_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}


def _prepared(fn):
    def run(spark, sf_dir):
        prepare(spark)
        return fn(spark, sf_dir)

    return run


def queries() -> dict:
    return {name: _prepared(fn) for name, fn in _QUERIES.items()} | {
        "pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
