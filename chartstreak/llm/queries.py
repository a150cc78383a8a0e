"""Registered queries of the operators, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from chartstreak.llm.byte_bpe import op8_byte_bpe
from chartstreak.llm.chat_format import OP2_SQL, op2_chat_format
from chartstreak.llm.conversation_repair import OP13_SQL, op13_conversation_repair
from chartstreak.llm.embedding_dedup import OP1_SQL, op1_embedding_dedup
from chartstreak.llm.exact_dedup import OP3_SQL, op3_exact_dedup
from chartstreak.llm.html_extract import op6_html_extract
from chartstreak.llm.language_id import op10_language_id
from chartstreak.llm.minhash_dedup import OP7_SQL, op7_minhash_dedup
from chartstreak.llm.packing import op5_best_fit_packing
from chartstreak.llm.substring_dedup import op4_substring_dedup
from chartstreak.llm.token_alignment import op12_token_alignment
from chartstreak.llm.topk_search import OP11_SQL, op11_topk_search
from chartstreak.llm.warc import OP9_SQL, op9_warc_index

REGISTRY = {
    "op1_embedding_dedup": (op1_embedding_dedup, OP1_SQL),
    "op2_chat_format": (op2_chat_format, OP2_SQL),
    "op3_exact_dedup": (op3_exact_dedup, OP3_SQL),
    "op4_substring_dedup": (op4_substring_dedup, None),
    "op5_best_fit_packing": (op5_best_fit_packing, None),
    "op6_html_extract": (op6_html_extract, None),
    "op7_minhash_dedup": (op7_minhash_dedup, OP7_SQL),
    "op8_byte_bpe": (op8_byte_bpe, None),
    "op9_warc_index": (op9_warc_index, OP9_SQL),
    "op10_language_id": (op10_language_id, None),
    "op11_topk_search": (op11_topk_search, OP11_SQL),
    "op12_token_alignment": (op12_token_alignment, None),
    "op13_conversation_repair": (op13_conversation_repair, OP13_SQL),
}
