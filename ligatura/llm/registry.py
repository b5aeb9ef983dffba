"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ligatura.llm.chat_trees import OP6_SQL, op6_chat_trees
from ligatura.llm.language_crf import op8_language_crf
from ligatura.llm.lm_scoring import op4_lm_scoring
from ligatura.llm.near_duplicates import op3_near_duplicates
from ligatura.llm.near_duplicates_sql import OP3_SQL
from ligatura.llm.pii_tagger import op9_pii_tagger
from ligatura.llm.quality_classifier import op1_quality_classifier
from ligatura.llm.quality_rules import op5_quality_rules
from ligatura.llm.retrieval_packing import op2_retrieval_packing
from ligatura.llm.template_decontamination import OP10_SQL, op10_template_decontamination
from ligatura.llm.token_files import op7_token_files


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_classifier": op1_quality_classifier,
        "op2_retrieval_packing": op2_retrieval_packing,
        "op3_near_duplicates": op3_near_duplicates,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_quality_rules": op5_quality_rules,
        "op6_chat_trees": op6_chat_trees,
        "op7_token_files": op7_token_files,
        "op8_language_crf": op8_language_crf,
        "op9_pii_tagger": op9_pii_tagger,
        "op10_template_decontamination": op10_template_decontamination,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_near_duplicates": OP3_SQL, "op6_chat_trees": OP6_SQL, "op10_template_decontamination": OP10_SQL}
