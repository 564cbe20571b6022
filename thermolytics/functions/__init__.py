from .dates import date_range_predicate, parse_timestamp, validate_date
from .maps import model_properties, prefixed, text_map
from .numeric import gt_not_nan, round6, safe_ratio
from .params import attach_row

__all__ = ["date_range_predicate", "parse_timestamp", "validate_date",
           "model_properties", "prefixed", "text_map", "gt_not_nan", "round6", "safe_ratio", "attach_row"]
