"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from doctables.llm import (
    bitpack,
    collocations,
    hyperminhash,
    jaccard,
    langid,
    mixing,
    packing,
    ppm,
    quality,
    repair,
    toolcalls,
    topk,
    warc,
)

QUERIES = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_mixture": mixing.op2_mixture,
    "op3_warc": warc.op3_warc,
    "op4_language": langid.op4_language,
    "op5_packed_ids": bitpack.op5_packed_ids,
    "op6_tool_calls": toolcalls.op6_tool_calls,
    "op7_exact_top_k": topk.op7_exact_top_k,
    "op8_jaccard_join": jaccard.op8_jaccard_join,
    "op9_packed_sequences": packing.op9_packed_sequences,
    "op10_ppm_scores": ppm.op10_ppm_scores,
    "op11_hyperminhash": hyperminhash.op11_hyperminhash,
    "op12_collocations": collocations.op12_collocations,
    "op13_conversation_repair": repair.op13_conversation_repair,
}
ORACLE = {**quality.ORACLE, **warc.ORACLE, **topk.ORACLE, **jaccard.ORACLE, **hyperminhash.ORACLE, **collocations.ORACLE, **repair.ORACLE}
