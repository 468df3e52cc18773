"""The queries of this subpackage by name, with their SQL where SQL can say it."""

from __future__ import annotations

from quillmesh.llm import align, byte_bpe, decontaminate, line_dedup, near_dups, packing, prefix_trie, quality, secrets, sentencepiece_fst, substring_dedup, token_counts, toxicity

QUERIES = {
    "op1_decontaminate": decontaminate.op1,
    "op2_secrets": secrets.op2,
    "op3_pack_tokens": packing.op3,
    "op4_near_dups": near_dups.op4,
    "op5_token_counts": token_counts.op5,
    "op6_substring_dedup": substring_dedup.op6,
    "op7_sentencepiece": sentencepiece_fst.op7,
    "op8_quality": quality.op8,
    "op9_toxicity": toxicity.op9,
    "op10_line_dedup": line_dedup.op10,
    "op11_byte_bpe": byte_bpe.op11,
    "op12_align_tokenizers": align.op12,
    "op13_prefix_trie": prefix_trie.op13,
}

ORACLES = {
    "op1_decontaminate": decontaminate.ORACLE,
    "op4_near_dups": near_dups.ORACLE,
    "op6_substring_dedup": substring_dedup.ORACLE,
    "op8_quality": quality.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
