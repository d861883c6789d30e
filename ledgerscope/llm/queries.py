"""One query per operator, and the SQL of those that DuckDB can express."""

from __future__ import annotations

from .bpe import op7_byte_bpe
from .chat import OP9_SQL, op9_chat_formatting
from .content_dedup import OP6_SQL, op6_exact_dedup
from .fm import op4_quality_classifier
from .ngram_join import OP5_SQL, op5_ngram_join
from .packing import op2_packing
from .paragraphs import op3_substring_dedup
from .phrases import OP11_SQL, op11_phrase_mining
from .prefix_counts import op12_token_counts
from .rans import op10_token_files
from .rules import op8_quality_rules
from .sharding import op1_sharding
from .whitening import op13_embedding_whitening

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_packing": op2_packing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_ngram_join": op5_ngram_join,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_quality_rules": op8_quality_rules,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_token_files": op10_token_files,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_token_counts": op12_token_counts,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLES = {"op5_ngram_join": OP5_SQL, "op6_exact_dedup": OP6_SQL, "op9_chat_formatting": OP9_SQL,
           "op11_phrase_mining": OP11_SQL}
