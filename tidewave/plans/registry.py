"""All plans by name."""

from __future__ import annotations

from tidewave.plans import activity, chain, estimation, fitted, labels, metrics, palindromes, reads, relations, signals
from tidewave.streaming import blocks
from tidewave.streaming import labels as stream_labels


def queries() -> dict:
    return signals.QUERIES | relations.QUERIES | metrics.QUERIES | reads.QUERIES | fitted.QUERIES | activity.QUERIES | chain.QUERIES | estimation.QUERIES | labels.QUERIES | palindromes.QUERIES | blocks.QUERIES | stream_labels.QUERIES


def oracle_sql() -> dict[str, str]:
    return signals.SQL | relations.SQL | metrics.SQL | reads.SQL | activity.SQL | chain.SQL | estimation.SQL | labels.SQL | palindromes.SQL
