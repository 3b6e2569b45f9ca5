"""The queries of this subpackage and their SQL, by key."""

from __future__ import annotations

from strata.llm.chat_format import OP9_SQL, op9_chat_format
from strata.llm.context_mixing import op5_context_mixing
from strata.llm.curve_packing import op3_curve_packing
from strata.llm.decontamination import op7_decontamination
from strata.llm.elias_fano import op8_token_output
from strata.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from strata.llm.license_lookup import OP6_SQL, op6_license_lookup
from strata.llm.near_dup import op4_near_dup
from strata.llm.quality_rules import op10_quality_rules
from strata.llm.sentence_pieces import op13_sentence_pieces
from strata.llm.url_filter import OP2_SQL, op2_url_filter
from strata.llm.warc import op1_warc
from strata.llm.whitening import op12_whitening

QUERIES = {
    "op1_warc": op1_warc,
    "op2_url_filter": op2_url_filter,
    "op3_curve_packing": op3_curve_packing,
    "op4_near_dup": op4_near_dup,
    "op5_context_mixing": op5_context_mixing,
    "op6_license_lookup": op6_license_lookup,
    "op7_decontamination": op7_decontamination,
    "op8_token_output": op8_token_output,
    "op9_chat_format": op9_chat_format,
    "op10_quality_rules": op10_quality_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_sentence_pieces": op13_sentence_pieces,
}

ORACLE = {
    "op2_url_filter": OP2_SQL,
    "op6_license_lookup": OP6_SQL,
    "op9_chat_format": OP9_SQL,
    "op11_hard_negatives": OP11_SQL,
}
