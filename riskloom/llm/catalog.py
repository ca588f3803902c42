"""The registered queries of this subpackage, by name, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from riskloom.llm.byte_bpe import op6_byte_bpe
from riskloom.llm.chat_format import OP13_SQL, op13_chat_format
from riskloom.llm.conversations import OP12_SQL, op12_conversation_repair
from riskloom.llm.language import op10_language_id
from riskloom.llm.licenses import op7_license_scan
from riskloom.llm.mixing import OP8_SQL, op8_mixing
from riskloom.llm.neighbours import op1_learned_partitions
from riskloom.llm.pseudonyms import op5_pseudonyms
from riskloom.llm.simhash import op3_simhash_near_dedup
from riskloom.llm.token_counts import op4_token_counts
from riskloom.llm.spelling import OP11_SQL, op11_spelling_variants
from riskloom.llm.toxicity import op2_toxicity
from riskloom.llm.vector_dedup import op9_nn_descent

QUERIES = {
    "op1_learned_partitions": op1_learned_partitions,
    "op2_toxicity": op2_toxicity,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_pseudonyms": op5_pseudonyms,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_license_scan": op7_license_scan,
    "op8_mixing": op8_mixing,
    "op9_nn_descent": op9_nn_descent,
    "op10_language_id": op10_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_chat_format": op13_chat_format,
}
ORACLES = {"op8_mixing": OP8_SQL, "op11_spelling_variants": OP11_SQL, "op12_conversation_repair": OP12_SQL, "op13_chat_format": OP13_SQL}
