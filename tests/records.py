"""Hand-written raw records."""

import json

KEYS = {"Closing": "closing_date"}


def attribute(label, value):
    return {"key": KEYS.get(label, "_".join(label.lower().split())), "label": label, "value": value}


def record(id=1, team="T", created="2024-01-01 00:00:00", items=None, text=None, **attributes):
    """One raw record; attributes by label with underscores for spaces, or ``items`` as (label, value) pairs."""
    pairs = items if items is not None else [(k.replace("_", " "), v) for k, v in attributes.items()]
    field_values = text if text is not None else json.dumps([attribute(label, v) for label, v in pairs])
    return (id, created, "UTC", field_values, 1, team, 2, "U", 3, "A", "B", "{}", "x@example.com")
