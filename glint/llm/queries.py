"""Registered queries of the training-data operators."""

from __future__ import annotations

from .bpe import op11_bpe
from .conversation_repair import OP12_SQL, op12_conversation_repair
from .embed_dedup import op3_embed_dedup
from .hard_negatives import OP13_SQL, op13_hard_negatives
from .html_extract import op5_html
from .langid import op6_langid
from .licenses import OP9_SQL, op9_licenses
from .line_dedup import OP2_SQL, op2_line_dedup
from .lm_score import op8_lm_score
from .mixing import op1_mixing
from .packing import op4_packing
from .simhash import op10_simhash
from .topk import OP7_SQL, op7_topk

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_line_dedup": op2_line_dedup,
    "op3_embed_dedup": op3_embed_dedup,
    "op4_packing": op4_packing,
    "op5_html": op5_html,
    "op6_langid": op6_langid,
    "op7_topk": op7_topk,
    "op8_lm_score": op8_lm_score,
    "op9_licenses": op9_licenses,
    "op10_simhash": op10_simhash,
    "op11_bpe": op11_bpe,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL = {
    "op2_line_dedup": OP2_SQL,
    "op7_topk": OP7_SQL,
    "op9_licenses": OP9_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
