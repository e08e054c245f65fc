"""All registered queries by name."""

from __future__ import annotations

from pulseframe.catalog.base import Query


def all_queries() -> dict[str, Query]:
    from pulseframe.catalog import labelling, modelling, roundtrips, streams, telemetry

    found: dict[str, Query] = {}
    for module in (telemetry, labelling, modelling, streams, roundtrips):
        for query in module.QUERIES:
            if query.name in found:
                raise ValueError(f"query '{query.name}' is registered twice")
            found[query.name] = query
    return found
