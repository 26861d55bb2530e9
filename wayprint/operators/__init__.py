from wayprint.operators.aggregates import (
    count_by, distinct_total, integer_mean_by, label_sums_by, majority_label_by, mean_and_count_by,
    mean_by, repeat_flag_by, sum_by, total,
)
from wayprint.operators.joins import attach, only_keys, paired_count_by, prefix_lookup
from wayprint.operators.upserts import apply_increment, merge_fields, merge_into

__all__ = [
    "count_by", "distinct_total", "integer_mean_by", "label_sums_by", "majority_label_by",
    "mean_and_count_by", "mean_by", "repeat_flag_by", "sum_by", "total", "attach", "only_keys", "paired_count_by",
    "prefix_lookup",
    "apply_increment", "merge_fields", "merge_into",
]
