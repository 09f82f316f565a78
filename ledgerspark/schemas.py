"""Declared schemas of the raw domain tables (no inference on read).

Ids and categories are STRING, months DATE, money and ratios DOUBLE, counts
INT/BIGINT. Readers apply these with ``spark.read.schema(...)``.
"""

from pyspark.sql import types as T

S, D, DT = T.StringType(), T.DoubleType(), T.DateType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


CMDB = _schema(("ci_id", S), ("service_area", S), ("site", S), ("vendor", S), ("ci_type", S),
               ("install_date", DT), ("monthly_cost", D), ("status", S))

TELEMETRY = _schema(("ci_id", S), ("service_area", S), ("period", DT), ("uptime_pct", D),
                    ("latency_ms", D), ("packet_loss_pct", D), ("mtbf_hours", D))

INCIDENTS = _schema(("incident_id", S), ("ci_id", S), ("service_area", S), ("site", S),
                    ("vendor", S), ("priority", S), ("opened", DT), ("mttr_hours", D),
                    ("cost_to_resolve", D))

INVOICES = _schema(("invoice_id", S), ("ci_id", S), ("vendor", S), ("service_area", S),
                   ("period", DT), ("contracted_rate", D), ("billed_amount", D),
                   ("ci_status", S), ("planted_error", S))

GL = _schema(("service_area", S), ("period", DT), ("amount", D), ("cost_center", S),
             ("gl_account", S))

BUDGET = _schema(("service_area", S), ("annual_budget", D), ("po_committed", D))

CONSUMPTION = _schema(("service_area", S), ("business_unit", S), ("units", D))

# View names for SQL users (raw table stems of the source layout).
VIEW_NAMES = {"invoices": "telecom_invoices", "incidents": "servicenow_incidents",
              "telemetry": "itom_telemetry", "cmdb": "servicenow_cmdb", "budget": "coupa_pos",
              "gl": "sap_gl", "consumption": "consumption", "weights": "chargeback_weights",
              "status_history": "cmdb_status_history"}

# The raw table names (file stems) of the source layout.
# Raw table name (file stem) -> declared schema. The weight matrix is wide with
# one column per business unit, so it is read with a header and unpivoted.
RAW_TABLES = {
    "servicenow_cmdb": CMDB,
    "itom_telemetry": TELEMETRY,
    "servicenow_incidents": INCIDENTS,
    "telecom_invoices": INVOICES,
    "sap_gl": GL,
    "coupa_pos": BUDGET,
}
