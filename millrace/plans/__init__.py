"""The registered queries: each operator bound to the given tables, with its SQL twin."""

from millrace.plans import (  # noqa: F401  (importing registers the queries)
    geo_queries,
    ml_queries,
    relational_queries,
    sampling_queries,
    series_queries,
    source_queries,
    stats_queries,
    text_queries,
)
from millrace.plans.registry import QUERIES  # noqa: F401
