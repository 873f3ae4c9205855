"""Import every query module so that the registry is filled."""

from queries import (  # noqa: F401
    batch_queries,
    changepoint_queries,
    cohort_queries,
    fusion_queries,
    interval_queries,
    model_queries,
    more_queries,
    order_queries,
    variant_queries,
    verify_queries,
)
