"""The queries of this package and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from termfold.llm import conversations, exact, fingerprints, jaccard, langid, lines, mixing, negatives, pieces, secrets, topk, toxicity, warc
from termfold.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    run.__name__ = query.__name__
    return run


_REGISTERED: list[Query] = [
    topk.op1_exact_topk,
    warc.op2_warc,
    pieces.op3_pieces,
    secrets.op4_secret_scan,
    jaccard.op5_jaccard_join,
    mixing.op6_mixing,
    toxicity.op7_toxicity,
    fingerprints.op8_fingerprints,
    langid.op9_language_id,
    lines.op10_line_dedup,
    negatives.op11_hard_negatives,
    exact.op12_exact_dedup,
    conversations.op13_conversation_trie,
]

ORACLE_SQL: dict[str, str] = {
    "op1_exact_topk": topk.OP1_SQL,
    "op2_warc": warc.OP2_SQL,
    "op11_hard_negatives": negatives.OP11_SQL,
    "op12_exact_dedup": exact.OP12_SQL,
    "op13_conversation_trie": conversations.OP13_SQL,
}


def queries() -> dict[str, Query]:
    return {query.__name__: _shipped(query) for query in _REGISTERED}
