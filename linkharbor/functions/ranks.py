"""Rank buckets as a scalar rule and as an aggregate."""

from __future__ import annotations

from linkharbor.config import RANK_BUCKET_LIMITS, RANK_BUCKETS, sql_list, sql_text

def rank_bucket(position: str) -> str:
    """The bucket of a position; null without one."""
    bounds = zip(RANK_BUCKET_LIMITS, RANK_BUCKETS)
    steps = " ".join(f"when {position} <= {limit} then {sql_text(name)}" for limit, name in bounds)
    return f"case {steps} when {position} is not null then {sql_text(RANK_BUCKETS[-1])} end"


def bucket_order(bucket: str) -> str:
    """1 for the best bucket; null for unknown names. A number aggregates inside the hash map."""
    return f"nullif(array_position(array({sql_list(RANK_BUCKETS)}), {bucket}), 0L)"


def bucket_name(order: str) -> str:
    steps = " ".join(f"when {i} then {sql_text(name)}" for i, name in enumerate(RANK_BUCKETS, start=1))
    return f"case {order} {steps} end"


def best_bucket(bucket: str) -> str:
    """Aggregate: the best known bucket of the group, null without one."""
    return bucket_name(f"min({bucket_order(bucket)})")
