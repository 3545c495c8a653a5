from rxvigil.operators.asof import asof_join
from rxvigil.operators.catalogue import (
    accepted_catalogue,
    admission_records,
    check_rules,
    rejected,
    rejection_envelopes,
    validate_catalogue,
)
from rxvigil.operators.deadletter import (
    Guarded,
    dlq_records,
    envelope,
    guard_expressions,
    guard_output,
    guard_records,
    processing_routes,
    split_failures,
)
from rxvigil.operators.enrich import (
    alert_records,
    enrich_alerts,
    known,
    narcotics_only,
    unknown,
    unknown_envelopes,
)
from rxvigil.operators.frequency import alert_event_time, count_alerts, late_alerts
from rxvigil.operators.latest import latest_by_key
from rxvigil.operators.lookup import lookup_join
from rxvigil.operators.surge import detect_price_surges, price_changes

__all__ = [
    "Guarded", "accepted_catalogue", "admission_records", "alert_event_time", "alert_records", "asof_join",
    "check_rules", "count_alerts", "detect_price_surges", "dlq_records", "enrich_alerts",
    "envelope", "guard_expressions", "guard_output", "guard_records", "known", "late_alerts", "latest_by_key",
    "lookup_join", "narcotics_only", "price_changes", "processing_routes", "rejected", "rejection_envelopes",
    "split_failures", "unknown", "unknown_envelopes", "validate_catalogue",
]
