from rxvigil.streaming.delivery import FencedError, Ledger, delivering_sink, read_committed
from rxvigil.streaming.pipelines import (
    start_alert_enrichment,
    start_alert_frequency,
    start_catalogue_admission,
    start_decode_failures,
    start_price_surges,
    start_processing,
    start_strict_enrichment,
    start_strict_price_surges,
)
from rxvigil.streaming.sinks import file_sink, log_sink, read_records
from rxvigil.streaming.stateful import stateful_asof, stateful_verdicts
from rxvigil.streaming.tables import ChangeTable

__all__ = [
    "ChangeTable", "FencedError", "Ledger", "delivering_sink", "file_sink", "log_sink", "read_committed",
    "read_records", "start_alert_enrichment", "start_alert_frequency", "start_catalogue_admission",
    "start_decode_failures", "start_price_surges", "start_processing", "start_strict_enrichment", "start_strict_price_surges",
    "stateful_asof", "stateful_verdicts",
]
