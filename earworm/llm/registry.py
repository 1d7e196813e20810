"""Registered queries of the operators and the SQL of those that SQL can state."""

from __future__ import annotations

from earworm.llm import filter_audit, quality
from earworm.llm.byte_bpe import op11_byte_bpe
from earworm.llm.filter_audit import op13_filter_audit
from earworm.llm.licenses import op6_license_scan
from earworm.llm.mixing import op4_mixing
from earworm.llm.multiset_hash import op2_multiset_hash
from earworm.llm.pieces import op7_piece_viterbi
from earworm.llm.pii import op1_pii
from earworm.llm.quality import op3_quality_rules
from earworm.llm.simhash import op9_simhash_near_dedup
from earworm.llm.token_counts import op10_token_counts
from earworm.llm.token_store import op8_token_store
from earworm.llm.toxicity import op5_toxicity_chain
from earworm.llm.turns import op12_conversation_repair

QUERIES = {
    "op1_pii": op1_pii,
    "op2_multiset_hash": op2_multiset_hash,
    "op3_quality_rules": op3_quality_rules,
    "op4_mixing": op4_mixing,
    "op5_toxicity_chain": op5_toxicity_chain,
    "op6_license_scan": op6_license_scan,
    "op7_piece_viterbi": op7_piece_viterbi,
    "op8_token_store": op8_token_store,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_filter_audit": op13_filter_audit,
}

#: The others rest on hashes, tokenizers, fitted models or spans: tests/llm holds
#: them against brute force.
ORACLE: dict[str, str] = {
    "op3_quality_rules": quality.ORACLE_SQL,
    "op13_filter_audit": filter_audit.ORACLE_SQL,
}
