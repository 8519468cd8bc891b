"""Registry of the subpackage: queries, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from shelfwise.llm import op01_token_counts as op1
from shelfwise.llm import op02_quality_mil as op2
from shelfwise.llm import op03_ngram_jaccard as op3
from shelfwise.llm import op04_lm_scoring as op4
from shelfwise.llm import op05_sentencepiece as op5
from shelfwise.llm import op06_vantage_point as op6
from shelfwise.llm import op07_language_id as op7
from shelfwise.llm import op08_decontamination as op8
from shelfwise.llm import op09_pii as op9
from shelfwise.llm import op10_chat_formatting as op10
from shelfwise.llm import op11_merkle_manifest as op11
from shelfwise.llm import op12_url_filter as op12
from shelfwise.llm import op13_periodic_runs as op13

QUERIES = {
    "op1_token_counts": op1.op1_token_counts,
    "op2_quality_mil": op2.op2_quality_mil,
    "op3_ngram_jaccard": op3.op3_ngram_jaccard,
    "op4_lm_scoring": op4.op4_lm_scoring,
    "op5_sentencepiece": op5.op5_sentencepiece,
    "op6_vantage_point": op6.op6_vantage_point,
    "op7_language_id": op7.op7_language_id,
    "op8_decontamination": op8.op8_decontamination,
    "op9_pii": op9.op9_pii,
    "op10_chat_formatting": op10.op10_chat_formatting,
    "op11_merkle_manifest": op11.op11_merkle_manifest,
    "op12_url_filter": op12.op12_url_filter,
    "op13_periodic_runs": op13.op13_periodic_runs,
}

ORACLE_SQL = {
    "op3_ngram_jaccard": op3.SQL,
    "op6_vantage_point": op6.SQL,
    "op8_decontamination": op8.SQL,
    "op10_chat_formatting": op10.SQL,
    "op11_merkle_manifest": op11.SQL,
    "op12_url_filter": op12.SQL,
    "op13_periodic_runs": op13.SQL,
}
