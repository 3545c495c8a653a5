"""The catalogue rules as a plain loop, to check the windowed operator against."""

ALLOWED = {
    "PENDING": {"ACTIVE", "WITHDRAWN"},
    "ACTIVE": {"SUSPENDED", "WITHDRAWN"},
    "SUSPENDED": {"ACTIVE", "WITHDRAWN"},
    "WITHDRAWN": set(),
}


def loop_verdicts(history, state=None):
    """``history``: (is_delete, status, rule) in order → verdicts and the final status."""
    verdicts = []
    for is_delete, status, rule in history:
        if is_delete:
            verdicts.append("TOMBSTONE")
            state = None
        elif rule:
            verdicts.append(rule)
        elif state is None or state == status or status in ALLOWED[state]:
            verdicts.append("OK")
            state = status
        else:
            verdicts.append("ILLEGAL_STATUS_TRANSITION")
    return verdicts, state
