"""One query for each numbered operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op2_byte_bpe
from .chat import OP9_SQL, op9_chat_formatting
from .codes import OP13_SQL, op13_anchors_vector_codes
from .decontaminate import op5_minhash_containment
from .language import op4_ecoc_language
from .lexical import OP12_SQL, op12_shared_lexical_search
from .mixing import OP11_SQL, op11_hash_threshold_mix
from .near_dedup import op7_probminhash_near_dedup
from .packing import op3_best_fit_shards
from .paragraphs import op8_paragraph_dedup
from .quality import op1_kneser_ney_quality
from .suffix_dedup import op6_suffix_array_dedup
from .topk import OP10_SQL, op10_cover_tree_top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_kneser_ney_quality, op2_byte_bpe, op3_best_fit_shards, op4_ecoc_language, op5_minhash_containment,
    op6_suffix_array_dedup, op7_probminhash_near_dedup, op8_paragraph_dedup, op9_chat_formatting, op10_cover_tree_top_k,
    op11_hash_threshold_mix, op12_shared_lexical_search, op13_anchors_vector_codes)}
ORACLES: dict[str, str] = {"op9_chat_formatting": OP9_SQL, "op10_cover_tree_top_k": OP10_SQL,
                           "op11_hash_threshold_mix": OP11_SQL, "op12_shared_lexical_search": OP12_SQL,
                           "op13_anchors_vector_codes": OP13_SQL}
