"""Generic DataFrame operators: latest rows, joins, grouping, batching, sampling."""

from rapport.operators.batching import bounded_batches, collect_batches, payloads
from rapport.operators.grouping import (
    distinct_counts,
    frequency,
    pivot_answers,
    share_of_max,
    sum_once,
)
from rapport.operators.joins import anti, expand_by_shared_key, mark_join, split_join
from rapport.operators.latest import (
    break_ties,
    first_answer,
    first_touch,
    latest_one,
    latest_ties,
    latest_value,
)
from rapport.operators.levels import LEVELS, Level, per_level
from rapport.operators.sampling import bootstrap_assign, dense_index, weighted_assign

__all__ = [
    "LEVELS",
    "Level",
    "anti",
    "bootstrap_assign",
    "bounded_batches",
    "break_ties",
    "collect_batches",
    "dense_index",
    "distinct_counts",
    "expand_by_shared_key",
    "first_answer",
    "first_touch",
    "frequency",
    "latest_one",
    "latest_ties",
    "latest_value",
    "mark_join",
    "payloads",
    "per_level",
    "pivot_answers",
    "share_of_max",
    "split_join",
    "sum_once",
    "weighted_assign",
]
