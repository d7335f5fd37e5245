"""Queries of the training-data operators, each over its whole table.

None has an oracle: dictionaries, automata, radix sorts, trees, Viterbi search and
file formats are not SQL. tests/llm holds each against brute force, an exact
round trip or held-out labels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from sokhan.llm.compression_quality import op8_compression_quality
from sokhan.llm.decontamination import op9_decontamination
from sokhan.llm.histogram_shards import op4_histogram_shards
from sokhan.llm.license_templates import op7_license_templates
from sokhan.llm.line_rules import op3_line_rules
from sokhan.llm.personal_data import op5_personal_data
from sokhan.llm.simhash import op10_simhash_bk_trees
from sokhan.llm.suffix_dedup import op2_suffix_dedup
from sokhan.llm.token_tables import op6_token_tables
from sokhan.llm.unigram import op1_sentencepiece


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_sentencepiece, op2_suffix_dedup, op3_line_rules, op4_histogram_shards, op5_personal_data, op6_token_tables, op7_license_templates, op8_compression_quality, op9_decontamination, op10_simhash_bk_trees)
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
