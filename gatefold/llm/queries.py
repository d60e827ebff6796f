"""Queries of the training-data operators and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gatefold.llm.byte_bpe import op7_byte_bpe
from gatefold.llm.chat import op4_role_repair
from gatefold.llm.language import op13_string_kernel
from gatefold.llm.line_dedup import OP3_SQL, op3_line_dedup
from gatefold.llm.manifest import OP11_SQL, op11_merkle_manifest
from gatefold.llm.matroska import op2_matroska
from gatefold.llm.mixing import OP10_SQL, op10_mix_targets
from gatefold.llm.near_dedup import op1_near_dedup
from gatefold.llm.quality import op5_kneser_ney
from gatefold.llm.rans_ids import op6_rans_ids
from gatefold.llm.runs import op12_periodic_runs
from gatefold.llm.sharding import OP9_SQL, op9_rendezvous_shards
from gatefold.llm.suffix_dedup import op8_suffix_dedup

OPERATORS = (op1_near_dedup, op2_matroska, op3_line_dedup, op4_role_repair, op5_kneser_ney, op6_rans_ids, op7_byte_bpe, op8_suffix_dedup, op9_rendezvous_shards, op10_mix_targets, op11_merkle_manifest, op12_periodic_runs, op13_string_kernel)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": OP3_SQL, "op9_rendezvous_shards": OP9_SQL, "op10_mix_targets": OP10_SQL, "op11_merkle_manifest": OP11_SQL}
