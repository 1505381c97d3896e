"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from flowmart.llm import (
    conversation_repair,
    embedding_dedup,
    filter_audit,
    html_extraction,
    licenses,
    lm_scoring,
    minhash_dedup,
    mixing,
    quality,
    sentencepiece_bpe,
    suffix_dedup,
    token_files,
    topk,
)

QUERIES = {
    "op1_lm_scoring": lm_scoring.op1_lm_scoring,
    "op2_topk": topk.op2_topk,
    "op3_mixing": mixing.op3_mixing,
    "op4_sentencepiece": sentencepiece_bpe.op4_sentencepiece,
    "op5_token_files": token_files.op5_token_files,
    "op6_minhash_dedup": minhash_dedup.op6_minhash_dedup,
    "op7_quality": quality.op7_quality,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_html_extraction": html_extraction.op9_html_extraction,
    "op10_licenses": licenses.op10_licenses,
    "op11_embedding_dedup": embedding_dedup.op11_embedding_dedup,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_filter_audit": filter_audit.op13_filter_audit,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {**topk.ORACLE, **mixing.ORACLE, **embedding_dedup.ORACLE, **filter_audit.ORACLE}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
