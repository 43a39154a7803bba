"""One query per operator of this subpackage, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from heliovent.llm.embedding_dedup import join_vectors
from heliovent.llm.exact_dedup import copies
from heliovent.llm.language_id import identify
from heliovent.llm.license_scan import scan_licenses
from heliovent.llm.lm_scoring import score_texts
from heliovent.llm.merkle_manifest import verify
from heliovent.llm.ngram_join import join_documents
from heliovent.llm.oracles import ORACLES
from heliovent.llm.packing import pack_documents
from heliovent.llm.periodic_runs import find_runs, planted_period, run_digests
from heliovent.llm.pii import find_private
from heliovent.llm.quality_rules import judge_quality
from heliovent.llm.sentencepiece_codec import encode_texts
from heliovent.llm.suffix_dedup import remove_repeats

Query = Callable[[SparkSession, str], DataFrame]


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where the session was started from another folder."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def over(table: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return operator(spark.read.parquet(f"{sf_dir}/{table}.parquet"))

    return query


QUERIES: dict[str, Query] = {
    "op1_lm_scoring": over("documents", score_texts),
    "op2_embedding_dedup": over("embeddings", join_vectors),
    "op3_best_fit_packing": over("documents", pack_documents),
    "op4_sentencepiece": over("documents", encode_texts),
    "op5_suffix_dedup": over("documents", remove_repeats),
    "op6_quality_rules": over("documents", judge_quality),
    "op7_pii": over("documents", find_private),
    "op8_ngram_join": over("documents", join_documents),
    "op9_language_id": over("documents", identify),
    "op10_license_scan": over("documents", scan_licenses),
    "op11_exact_dedup": over("documents", lambda docs: copies(docs, keep="largest")),
    "op12_periodic_runs": over("documents", lambda docs: run_digests(find_runs(docs, plant=planted_period))),
    "op13_merkle_manifest": over("documents", verify),
}

__all__ = ["ORACLES", "QUERIES", "importable"]
