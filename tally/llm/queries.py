"""Registered queries of the training-data operators."""

from __future__ import annotations

from tally.llm.embedding_links import op7_nn_descent
from tally.llm.exact_dedup import OP6_SQL, op6_exact_dedup
from tally.llm.filter_audit import OP11_SQL, op11_filter_audit
from tally.llm.jaccard_join import op10_ngram_jaccard
from tally.llm.licenses import op3_license_scan
from tally.llm.packing import op1_hilbert_pack
from tally.llm.quality import op4_quality
from tally.llm.secrets import op8_secret_scan
from tally.llm.sentencepieces import op9_sentencepiece
from tally.llm.spelling import op13_spelling_variants
from tally.llm.suffix_tree import op12_suffix_tree_scores
from tally.llm.toxicity import op5_toxicity
from tally.llm.url_rules import op2_url_rules

QUERIES = {
    "op1_hilbert_pack": op1_hilbert_pack,
    "op2_url_rules": op2_url_rules,
    "op3_license_scan": op3_license_scan,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_nn_descent": op7_nn_descent,
    "op8_secret_scan": op8_secret_scan,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_filter_audit": op11_filter_audit,
    "op12_suffix_tree_scores": op12_suffix_tree_scores,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL = {
    "op6_exact_dedup": OP6_SQL,
    "op11_filter_audit": OP11_SQL,
}
