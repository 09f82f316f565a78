"""The bundle of raw domain tables every operator family reads from."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame


@dataclass
class Sources:
    cmdb: DataFrame
    invoices: DataFrame
    incidents: DataFrame
    telemetry: DataFrame
    budget: DataFrame
    consumption: DataFrame | None = None
    weights: DataFrame | None = None   # long (service_area, business_unit, weight)
    gl: DataFrame | None = None
    status_history: DataFrame | None = None   # (ci_id, status, valid_from)

    def items(self):
        for f in fields(self):
            v = getattr(self, f.name)
            if v is not None:
                yield f.name, v
