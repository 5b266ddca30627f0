"""Operators for training corpora and their registered queries."""

from loadsieve.llm.alignment import op13_token_alignment
from loadsieve.llm.audit import AUDIT_SQL, op11_filter_audit
from loadsieve.llm.classifier import op10_nb_svm_quality
from loadsieve.llm.language import op12_gru_language
from loadsieve.llm.mixing import op3_pivotal_mixing
from loadsieve.llm.packing import op5_bin_completion
from loadsieve.llm.repetition import op1_suffix_array_repetition
from loadsieve.llm.secrets import op4_trigram_index, secrets_sql
from loadsieve.llm.shards import op6_jump_shards
from loadsieve.llm.simhash import op7_simhash_byte_index
from loadsieve.llm.surrogates import op2_surrogates
from loadsieve.llm.topk import TOPK_SQL, op9_ball_tree_topk
from loadsieve.llm.urls import op8_path_templates

QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_array_repetition,
        op2_surrogates,
        op3_pivotal_mixing,
        op4_trigram_index,
        op5_bin_completion,
        op6_jump_shards,
        op7_simhash_byte_index,
        op8_path_templates,
        op9_ball_tree_topk,
        op10_nb_svm_quality,
        op11_filter_audit,
        op12_gru_language,
        op13_token_alignment,
    )
}
ORACLES = {"op4_trigram_index": secrets_sql(), "op9_ball_tree_topk": TOPK_SQL, "op11_filter_audit": AUDIT_SQL}
