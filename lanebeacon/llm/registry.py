"""The queries of this subpackage and their SQL twins, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lanebeacon.llm import (
    bpe,
    chat,
    fingerprints,
    jaccard,
    merkle,
    mixing,
    neighbours,
    phrases,
    quality,
    secrets,
    sharding,
    token_counts,
    urls,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": sharding.op1_sharding,
        "op2_byte_bpe": bpe.op2_byte_bpe,
        "op3_neighbours": neighbours.op3_neighbours,
        "op4_quality": quality.op4_quality,
        "op5_secrets": secrets.op5_secrets,
        "op6_token_counts": token_counts.op6_token_counts,
        "op7_jaccard_join": jaccard.op7_jaccard_join,
        "op8_url_filter": urls.op8_url_filter,
        "op9_fingerprints": fingerprints.op9_fingerprints,
        "op10_mixing": mixing.op10_mixing,
        "op11_chat": chat.op11_chat,
        "op12_merkle": merkle.op12_merkle,
        "op13_collocations": phrases.op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {"op11_chat": chat.OP11_SQL, "op12_merkle": merkle.OP12_SQL, "op13_collocations": phrases.OP13_SQL}
