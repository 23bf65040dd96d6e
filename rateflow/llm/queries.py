"""The registered queries of this package; ``ORACLE_SQL`` is the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rateflow.llm.op1_license_scan import op1_license_scan
from rateflow.llm.op2_suffix_dedup import op2_suffix_dedup
from rateflow.llm.op3_warc import op3_warc
from rateflow.llm.op4_quality_pu import op4_quality_pu
from rateflow.llm.op5_collision_dedup import op5_collision_dedup
from rateflow.llm.op6_byte_bpe import op6_byte_bpe
from rateflow.llm.op7_secret_scan import op7_secret_scan
from rateflow.llm.op8_decontaminate import op8_decontaminate
from rateflow.llm.op9_bag_minhash import op9_bag_minhash
from rateflow.llm.op10_fm_dedup import op10_fm_dedup
from rateflow.llm.op11_fill_in_middle import op11_fill_in_middle
from rateflow.llm.op12_spelling_variants import op12_spelling_variants
from rateflow.llm.op13_pii_sanitize import op13_pii_sanitize
from rateflow.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_warc": op3_warc,
    "op4_quality_pu": op4_quality_pu,
    "op5_collision_dedup": op5_collision_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_secret_scan": op7_secret_scan,
    "op8_decontaminate": op8_decontaminate,
    "op9_bag_minhash": op9_bag_minhash,
    "op10_fm_dedup": op10_fm_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_pii_sanitize": op13_pii_sanitize,
}

