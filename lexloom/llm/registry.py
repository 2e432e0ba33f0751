"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexloom.llm.annsearch import op4_nearest_neighbours
from lexloom.llm.embdedup import op10_embedding_near_dedup
from lexloom.llm.linededup import OP1_SQL, op1_line_dedup
from lexloom.llm.mixing import OP3_SQL, op3_mixing
from lexloom.llm.packing import op9_best_fit_packing
from lexloom.llm.quality import op6_quality_classifier
from lexloom.llm.simhash import op7_simhash_near_dedup
from lexloom.llm.suffixdedup import op8_suffix_dedup
from lexloom.llm.toxicity import op5_toxicity
from lexloom.llm.urlfilter import OP2_SQL, op2_url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_url_filter": op2_url_filter,
        "op3_mixing": op3_mixing,
        "op4_nearest_neighbours": op4_nearest_neighbours,
        "op5_toxicity": op5_toxicity,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_simhash_near_dedup": op7_simhash_near_dedup,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_embedding_near_dedup": op10_embedding_near_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op2_url_filter": OP2_SQL, "op3_mixing": OP3_SQL}
