"""Queries registered for checks and benchmarks, by topic."""

from __future__ import annotations

from bloomledger.workloads.common import Query


def registry() -> dict[str, Query]:
    """All registered queries by name."""
    from bloomledger.workloads import (
        feed_queries,
        matching_queries,
        price_queries,
        report_queries,
        text_queries,
    )

    merged: dict[str, Query] = {}
    for module in (text_queries, price_queries, feed_queries, matching_queries, report_queries):
        merged.update(module.QUERIES)
    return merged
