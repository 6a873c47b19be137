"""DataFrame operators: staging and dedup, joins, aggregates, reshaping,
attribution and data checks."""

from tidemark.operators import aggs, attribution, checks, joins, reshape, stage  # noqa: F401
