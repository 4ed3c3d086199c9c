"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, resampling
from .alignment import op12_alignment
from .curves import op9_nearest
from .decontamination import op3_decontamination
from .language_id import op4_language_id
from .line_dedup import op8_line_dedup
from .ngram_join import op10_ngram_join
from .packing import op6_packing
from .pieces import op13_pieces
from .quality import op5_quality
from .resampling import op11_resampling
from .sharding import op7_sharding
from .token_files import op2_token_files
from .toxicity import op1_toxicity


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline                     # the top of the repository is on the path

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_token_files": op2_token_files,
        "op3_decontamination": op3_decontamination,
        "op4_language_id": op4_language_id,
        "op5_quality": op5_quality,
        "op6_packing": op6_packing,
        "op7_sharding": op7_sharding,
        "op8_line_dedup": op8_line_dedup,
        "op9_nearest": op9_nearest,
        "op10_ngram_join": op10_ngram_join,
        "op11_resampling": op11_resampling,
        "op12_alignment": op12_alignment,
        "op13_pieces": op13_pieces,
        "pipeline": _pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_decontamination": decontamination.ORACLE_SQL,
        "op11_resampling": resampling.ORACLE_SQL,
    }
