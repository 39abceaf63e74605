"""Registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from inkwell.llm.bpe import op4_bpe_trie
from inkwell.llm.chat import ORACLE_OP6, op6_reply_trees
from inkwell.llm.decontam import ORACLE_OP12, op12_wu_manber_decontamination
from inkwell.llm.embeddings import op10_itq_near_dedup
from inkwell.llm.filter_audit import ORACLE_OP13, op13_filter_audit
from inkwell.llm.jaccard import op5_ngram_jaccard
from inkwell.llm.langid import op7_ppm_language
from inkwell.llm.licenses import op8_license_scan, oracle_op8
from inkwell.llm.lm import op9_attention_lm
from inkwell.llm.packing import op2_best_fit_packing
from inkwell.llm.quality import op3_quality_rules, oracle_op3
from inkwell.llm.search import ORACLE_OP11, op11_max_sketch_search
from inkwell.llm.toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_quality_rules": op3_quality_rules,
    "op4_bpe_trie": op4_bpe_trie,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_reply_trees": op6_reply_trees,
    "op7_ppm_language": op7_ppm_language,
    "op8_license_scan": op8_license_scan,
    "op9_attention_lm": op9_attention_lm,
    "op10_itq_near_dedup": op10_itq_near_dedup,
    "op11_max_sketch_search": op11_max_sketch_search,
    "op12_wu_manber_decontamination": op12_wu_manber_decontamination,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES = {
    "op3_quality_rules": oracle_op3(),
    "op6_reply_trees": ORACLE_OP6,
    "op8_license_scan": oracle_op8(),
    "op11_max_sketch_search": ORACLE_OP11,
    "op12_wu_manber_decontamination": ORACLE_OP12,
    "op13_filter_audit": ORACLE_OP13,
}
