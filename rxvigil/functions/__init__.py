from rxvigil.functions.expressions import (
    dlq_topic,
    half_up_2dp,
    is_blank,
    iso_instant,
    json_record,
    less_than,
    positive,
    record_position,
    severity_label,
    transition_allowed,
    window_key,
)

__all__ = [
    "dlq_topic", "half_up_2dp", "is_blank", "iso_instant", "json_record", "less_than",
    "positive", "record_position", "severity_label", "transition_allowed", "window_key",
]
