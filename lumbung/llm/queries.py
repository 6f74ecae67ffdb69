"""Registered queries of the training-data operators, and their SQL where SQL can state them."""

from __future__ import annotations

from lumbung.llm.alignment import op13_tokenizer_alignment
from lumbung.llm.chat_format import ORACLE_OP1, op1_chat_format
from lumbung.llm.collocations import ORACLE_OP11, op11_phrase_collocations
from lumbung.llm.exact_dedup import ORACLE_OP6, op6_exact_dedup
from lumbung.llm.fertility import op4_tokeniser_fertility
from lumbung.llm.jaccard_join import op8_jaccard_join
from lumbung.llm.license_scan import ORACLE_OP7, op7_license_scan
from lumbung.llm.mixing import ORACLE_OP9, op9_pfair_mixing
from lumbung.llm.multiset_hash import op12_multiset_fingerprints
from lumbung.llm.packing import op2_bucket_packing
from lumbung.llm.token_output import op10_repair_tokens
from lumbung.llm.toxicity import op3_deobfuscated_toxicity
from lumbung.llm.url_filter import op5_url_trees

QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_bucket_packing": op2_bucket_packing,
    "op3_deobfuscated_toxicity": op3_deobfuscated_toxicity,
    "op4_tokeniser_fertility": op4_tokeniser_fertility,
    "op5_url_trees": op5_url_trees,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_pfair_mixing": op9_pfair_mixing,
    "op10_repair_tokens": op10_repair_tokens,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_multiset_fingerprints": op12_multiset_fingerprints,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

ORACLE = {
    "op1_chat_format": ORACLE_OP1,
    "op6_exact_dedup": ORACLE_OP6,
    "op7_license_scan": ORACLE_OP7,
    "op9_pfair_mixing": ORACLE_OP9,
    "op11_phrase_collocations": ORACLE_OP11,
}
