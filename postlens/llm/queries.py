"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from postlens.llm import hard_negatives, line_dedup, main_text, near_dedup, url_rules, warc
from postlens.llm.arrow_tokens import op2_arrow_tokens
from postlens.llm.decontaminate import op8_decontaminate
from postlens.llm.hard_negatives import op11_hard_negatives
from postlens.llm.line_dedup import op4_line_dedup
from postlens.llm.main_text import op3_main_text
from postlens.llm.near_dedup import op9_minhash_near_dedup
from postlens.llm.packing import op7_best_fit_packing
from postlens.llm.private_data import op12_private_data
from postlens.llm.quality import op6_quality_rules
from postlens.llm.suffix_dedup import op5_suffix_dedup
from postlens.llm.token_alignment import op13_token_alignment
from postlens.llm.url_rules import op10_url_rules
from postlens.llm.warc import op1_warc_index

QUERIES = {
    f.__name__: f
    for f in (
        op1_warc_index, op2_arrow_tokens, op3_main_text, op4_line_dedup, op5_suffix_dedup, op6_quality_rules, op7_best_fit_packing,
        op8_decontaminate, op9_minhash_near_dedup, op10_url_rules,
        op11_hard_negatives, op12_private_data, op13_token_alignment,
    )
}
SQL = {
    "op1_warc_index": warc.SQL,
    "op3_main_text": main_text.SQL,
    "op4_line_dedup": line_dedup.SQL,
    "op9_minhash_near_dedup": near_dedup.SQL,
    "op10_url_rules": url_rules.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
}
