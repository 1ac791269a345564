"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .alignment import op11_alignment
from .arrow_output import op8_arrow_sequences
from .imatch import op3_fingerprints
from .line_dedup import op1_line_dedup
from .mixing import OP7_SQL, op7_mixing
from .packing import op10_packing
from .quality import op2_quality
from .repeats import op13_repeats
from .resampling import op12_resampling
from .secrets import op5_secrets
from .simhash import op9_simhash
from .token_counts import op6_token_counts
from .topk import OP4_SQL, op4_top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_line_dedup, op2_quality, op3_fingerprints, op4_top_k, op5_secrets, op6_token_counts, op7_mixing, op8_arrow_sequences, op9_simhash, op10_packing, op11_alignment, op12_resampling, op13_repeats)}
ORACLE_SQL: dict[str, str] = {"op4_top_k": OP4_SQL, "op7_mixing": OP7_SQL}
