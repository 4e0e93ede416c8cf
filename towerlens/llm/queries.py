"""Queries of the text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from towerlens.llm import op3_exact, op4_mixture, op7_urls
from towerlens.llm.op1_substring import op1_substring_dedup
from towerlens.llm.op10_mil import op10_quality_classifier
from towerlens.llm.op11_whitening import op11_embedding_whitening
from towerlens.llm.op12_pieces import op12_sentencepiece
from towerlens.llm.op13_align import op13_token_alignment
from towerlens.llm.op2_suffix import op2_suffix_dedup
from towerlens.llm.op5_license import op5_license_scan
from towerlens.llm.op6_quality import op6_quality_rules
from towerlens.llm.op8_jaccard import op8_jaccard_join
from towerlens.llm.op9_bpe import op9_bpe

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_exact_dedup": op3_exact.op3_exact_dedup,
    "op4_source_mixing": op4_mixture.op4_source_mixing,
    "op5_license_scan": op5_license_scan,
    "op6_quality_rules": op6_quality_rules,
    "op7_url_rules": op7_urls.op7_url_rules,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_bpe": op9_bpe,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    "op3_exact_dedup": op3_exact.SQL,
    "op4_source_mixing": op4_mixture.SQL,
    "op7_url_rules": op7_urls.SQL,
}
