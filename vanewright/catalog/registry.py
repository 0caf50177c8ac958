"""All registered queries."""

from __future__ import annotations

from vanewright.catalog import ordered, profiles, projections, streams, texts
from vanewright.catalog.views import Entry

MODULES = [projections, profiles, ordered, texts, streams]


def entries() -> dict[str, Entry]:
    found: dict[str, Entry] = {}
    for module in MODULES:
        for entry in module.ENTRIES:
            if entry.key in found:
                raise ValueError(f"duplicate key {entry.key}")
            found[entry.key] = entry
    return found
