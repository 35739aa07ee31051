"""The corpus queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from yoyflow.llm import oracle
from yoyflow.llm.decontaminate import op5_decontaminate
from yoyflow.llm.hard_negatives import op12_hard_negatives
from yoyflow.llm.kmeans_tree import op6_nearest
from yoyflow.llm.language_id import op4_language_id
from yoyflow.llm.lattice_lm import op8_lattice_lm
from yoyflow.llm.ngram_join import op1_ngram_join
from yoyflow.llm.prefix_trie import op13_prefix_trie
from yoyflow.llm.quality_rules import op11_quality_rules
from yoyflow.llm.recompression import op9_repeats
from yoyflow.llm.secrets import op10_secrets
from yoyflow.llm.sentencepiece_codec import op2_sentencepiece
from yoyflow.llm.token_counts import op3_token_counts
from yoyflow.llm.token_files import op7_token_files


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    all_of_them = (
        op1_ngram_join, op2_sentencepiece, op3_token_counts, op4_language_id, op5_decontaminate, op6_nearest, op7_token_files, op8_lattice_lm,
        op9_repeats, op10_secrets, op11_quality_rules, op12_hard_negatives, op13_prefix_trie,
    )
    return {f.__name__: f for f in all_of_them}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": oracle.OP1,
        "op5_decontaminate": oracle.OP5,
        "op9_repeats": oracle.OP9,
        "op11_quality_rules": oracle.OP11,
        "op12_hard_negatives": oracle.OP12,
        "op13_prefix_trie": oracle.OP13,
    }
