"""All registered queries."""

from bankops.plans import (  # noqa: F401
    column_queries,
    join_queries,
    load_queries,
    ml_queries,
    tables_queries,
    window_queries,
)
from bankops.plans.registry import ORACLES, QUERIES  # noqa: F401
