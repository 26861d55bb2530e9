from wayprint.functions.predicates import (
    any_prefix, any_present, has_prefix, in_window, in_values, not_blank, present, day_window,
)
from wayprint.functions.extract import (
    document_id, explode_codes, json_field, json_fields, label_flag, prefix_id, split_codes, url_segment,
)
from wayprint.functions.numbers import decimal_of, integer_mean_of, limbs_of, mean_of, number_of, priority_of, reaches, with_amount

__all__ = [
    "any_prefix", "any_present", "has_prefix", "in_window", "in_values", "not_blank", "present", "day_window",
    "document_id", "explode_codes", "json_field", "json_fields", "label_flag", "prefix_id",
    "split_codes", "url_segment", "decimal_of", "integer_mean_of", "limbs_of", "mean_of", "number_of", "priority_of", "reaches", "with_amount",
]
