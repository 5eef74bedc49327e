"""The registered queries of this folder and their SQL counterparts."""

from __future__ import annotations

from .bpe import op8_bpe
from .chat import ORACLE_OP6, op6_chat_formatting
from .decontam import ORACLE_OP2, op2_decontamination
from .html import op10_html
from .katz import op1_katz
from .neardup import ORACLE_OP3, op3_near_duplicates
from .phrases import ORACLE_OP11, op11_collocations
from .pii import op12_personal_data
from .quality import op5_quality
from .repeats import ORACLE_OP7, op7_repeats
from .runs import op13_periodic_runs
from .toxicity import op9_toxicity
from .warc import ORACLE_OP4, op4_warc

QUERIES = {
    "op1_katz": op1_katz,
    "op2_decontamination": op2_decontamination,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_warc": op4_warc,
    "op5_quality": op5_quality,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_repeats": op7_repeats,
    "op8_bpe": op8_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_html": op10_html,
    "op11_collocations": op11_collocations,
    "op12_personal_data": op12_personal_data,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE = {
    "op2_decontamination": ORACLE_OP2,
    "op3_near_duplicates": ORACLE_OP3,
    "op4_warc": ORACLE_OP4,
    "op6_chat_formatting": ORACLE_OP6,
    "op7_repeats": ORACLE_OP7,
    "op11_collocations": ORACLE_OP11,
}
