"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from gridstream.llm.chat_format import OP1_SQL, op1_chat_format
from gridstream.llm.conversation_repair import OP11_SQL, op11_conversation_repair
from gridstream.llm.language_id import op3_language_id
from gridstream.llm.lexical_search import OP13_SQL, op13_lexical_search
from gridstream.llm.mixing import OP9_SQL, op9_mixing
from gridstream.llm.near_dedup import OP8_SQL, op8_near_dedup
from gridstream.llm.packing import op12_packing
from gridstream.llm.quality_rules import OP6_SQL, op6_quality_rules
from gridstream.llm.sentencepiece_bpe import op5_sentencepiece
from gridstream.llm.substring_dedup import OP10_SQL, op10_substring_dedup
from gridstream.llm.token_files import op2_token_files
from gridstream.llm.topk_search import OP4_SQL, op4_topk_search
from gridstream.llm.url_rules import OP7_SQL, op7_url_rules

QUERIES = {f.__name__: f for f in (op1_chat_format, op2_token_files, op3_language_id, op4_topk_search, op5_sentencepiece, op6_quality_rules,
                                   op7_url_rules, op8_near_dedup, op9_mixing,
                                   op10_substring_dedup, op11_conversation_repair, op12_packing, op13_lexical_search)}
SQL = {"op1_chat_format": OP1_SQL, "op4_topk_search": OP4_SQL, "op6_quality_rules": OP6_SQL, "op7_url_rules": OP7_SQL, "op8_near_dedup": OP8_SQL,
       "op9_mixing": OP9_SQL, "op10_substring_dedup": OP10_SQL, "op11_conversation_repair": OP11_SQL,
       "op13_lexical_search": OP13_SQL}
