"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    decontaminate, embedding_dedup, exact_dedup, importance, language, licences, mixing, pii, repeats, secrets, simhash,
    token_counts, vector_codes,
)
from tidemark.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def prepared(spark: SparkSession) -> SparkSession:
    """Whole texts go to Python workers, so batches are bounded by hundreds of rows and by bytes, not by 10,000 rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    return configure(spark)


def _configured(run: Query) -> Query:
    return lambda spark, sf_dir: run(prepared(spark), sf_dir)


def queries() -> dict[str, Query]:
    listed = [
        token_counts.op1_token_counts,
        secrets.op2_secrets,
        mixing.op3_mix_sources,
        exact_dedup.op4_exact_dedup,
        language.op5_language_id,
        decontaminate.op6_decontaminate,
        licences.op7_licences,
        pii.op8_pii,
        simhash.op9_simhash,
        repeats.op10_suffix_dedup,
        embedding_dedup.op11_embedding_dedup,
        importance.op12_importance_resampling,
        vector_codes.op13_vector_codes,
    ]
    import corpus_pipeline  # it is made of the operators above and uses ``prepared``

    return {run.__name__: _configured(run) for run in listed} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_mix_sources": mixing.ORACLE,
        "op4_exact_dedup": exact_dedup.ORACLE,
        "op6_decontaminate": decontaminate.ORACLE,
        "op7_licences": licences.ORACLE,
        "op11_embedding_dedup": embedding_dedup.ORACLE,
        "op13_vector_codes": vector_codes.ORACLE,
    }
