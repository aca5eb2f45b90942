"""The queries of this folder by name, and SQL for those that SQL can express."""

from __future__ import annotations

from tallygate.llm import (
    byte_bpe,
    conversations,
    html_text,
    lexical_search,
    licenses,
    mixing,
    quality_cnn,
    quality_rules,
    sentencepiece_bpe,
    simhash,
    spotsigs,
    url_filters,
    warc,
)

QUERIES = {
    "op1_simhash_near_dedup": simhash.op1_simhash_near_dedup,
    "op2_warc": warc.op2_warc,
    "op3_url_filters": url_filters.op3_url_filters,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_license_scans": licenses.op5_license_scans,
    "op6_document_fingerprints": spotsigs.op6_document_fingerprints,
    "op7_html_extraction": html_text.op7_html_extraction,
    "op8_mixing_sources": mixing.op8_mixing_sources,
    "op9_sentencepiece": sentencepiece_bpe.op9_sentencepiece,
    "op10_quality_classifier": quality_cnn.op10_quality_classifier,
    "op11_ranked_lexical_search": lexical_search.op11_ranked_lexical_search,
    "op12_byte_level_bpe": byte_bpe.op12_byte_level_bpe,
    "op13_conversation_repair": conversations.op13_conversation_repair,
}

ORACLES = {
    "op2_warc": warc.OP2_SQL,
    "op3_url_filters": url_filters.OP3_SQL,
    "op4_quality_rules": quality_rules.OP4_SQL,
    "op8_mixing_sources": mixing.OP8_SQL,
    "op11_ranked_lexical_search": lexical_search.OP11_SQL,
}
