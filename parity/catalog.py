"""Registration of queries, each with the SQL it must agree with, if there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parity.chain import oracle

Query = Callable[[SparkSession, str], DataFrame]

# Steps without a query of their own, and the query whose result depends on them.
COVERED_BY = {
    "model_inputs": "bi",
    "drop_helper_col": "dedup_latest",
    "filter_rank_one": "dedup_latest",
    "sort_in_window": "dedup_latest",
    "pred_range": "clean_heart_rate",
    "pred_or_and_ne": "dq_heart_rate_valid",
    "star_projection": "scan_bi_mart",
    "stream_stateless_project": "ingest_audit_cols",
    "stream_checkpoint": "sink_stream_append",
    "stream_append_mode": "sink_stream_append",
    "stream_trigger": "sink_stream_append",
}

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``. ``sql`` selects from the tables of the chain."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return function

    return register
