"""Column expressions (built-in Spark functions only, no UDFs)."""

from eventmart.functions.timestamps import event_time, whole_seconds_between
from eventmart.functions.text import clean_url, not_blank, normalized_event_type
from eventmart.functions.props import PropertyReader
from eventmart.functions.urls import url_query_param
from eventmart.functions.metrics import safe_ratio

__all__ = [
    "event_time",
    "whole_seconds_between",
    "clean_url",
    "not_blank",
    "normalized_event_type",
    "PropertyReader",
    "url_query_param",
    "safe_ratio",
]
