"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from weirwalk.llm.importance import op13_importance_resampling
from weirwalk.llm.masked_likelihood import op2_masked_likelihood
from weirwalk.llm.mixing import OP9_SQL, op9_source_mix
from weirwalk.llm.near_dedup import op7_hyperminhash
from weirwalk.llm.packing import op10_best_fit
from weirwalk.llm.projection_forest import op6_projection_forest
from weirwalk.llm.quality_neighbours import op3_quality_neighbours
from weirwalk.llm.repeated_bytes import op12_merged_transforms
from weirwalk.llm.secret_forest import op4_secret_forest
from weirwalk.llm.sharding import op5_rendezvous_shards
from weirwalk.llm.suffix_repeats import op8_sql, op8_suffix_repeats
from weirwalk.llm.token_files import op1_token_files
from weirwalk.llm.whitening import op11_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_masked_likelihood": op2_masked_likelihood,
    "op3_quality_neighbours": op3_quality_neighbours,
    "op4_secret_forest": op4_secret_forest,
    "op5_rendezvous_shards": op5_rendezvous_shards,
    "op6_projection_forest": op6_projection_forest,
    "op7_hyperminhash": op7_hyperminhash,
    "op8_suffix_repeats": op8_suffix_repeats,
    "op9_source_mix": op9_source_mix,
    "pipeline": corpus_pipeline.run,
    "op10_best_fit": op10_best_fit,
    "op11_whitening": op11_whitening,
    "op12_merged_transforms": op12_merged_transforms,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE_SQL: dict[str, str] = {"op8_suffix_repeats": op8_sql(), "op9_source_mix": OP9_SQL}
