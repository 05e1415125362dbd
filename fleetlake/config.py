"""Endpoint registry: which columns of each landed endpoint get which type, and the merge key.

Unknown endpoints get an empty config (no casts, no merge key).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class EndpointConfig:
    endpoint: str
    table: str
    datetime_cols: tuple[str, ...] = ()
    long_int_cols: tuple[str, ...] = ()
    boolean_cols: tuple[str, ...] = ()
    merge_key: str | None = None          # None on a daily table = composite (asset_id, date)
    daily: bool = False
    renames: dict = field(default_factory=dict)

    @property
    def configured(self) -> set[str]:
        return set(self.datetime_cols) | set(self.long_int_cols) | set(self.boolean_cols) | set(DOUBLE_COLS)


# Measure columns cast to double on the daily path (after the long casts)
DOUBLE_COLS = (
    "utilization_percentage",
    "expected_run_hours",
    "asset_external_rental_rate",
    "asset_internal_rental_rate",
    "asset_target_work_hours",
    "asset_target_work_miles",
    "total_idle_fuel_usage_liters",
    "working_percentage",
    "idle_percentage",
)

# The per-endpoint column types of the fleet API (static tables, full refresh)
STATIC_ENDPOINTS = (
    EndpointConfig(
        "asset-financials", "asset_financials",
        datetime_cols=("purchase_date", "created_at", "updated_at", "last_reading_date", "rental_start",
                       "rental_actual_end", "rental_forecasted_end", "rpo_expiration", "sold_date",
                       "insurance_expiration_date", "insurance_start_date"),
        long_int_cols=("difference_labor_cost", "disposition_broker_fee", "hauling_cost", "remaining_days",
                       "loan_term_in_months", "lease_term_in_months"),
        boolean_cols=("rpo_option",)),
    EndpointConfig(
        "assets", "assets",
        datetime_cols=("created_at", "updated_at", "tracker_last_data_received", "tracker_installed_at",
                       "tracker_verification_date"),
        long_int_cols=("year", "engine_year", "dimensions_tire_quantity", "tracker_days_since_last_location_report"),
        boolean_cols=("billable", "ifta", "vehicle_type_hazmat", "vehicle_type_apportioned", "eld_enabled",
                      "tracker_associated", "ignore_ecu_idle_hours")),
    EndpointConfig(
        "asset-assignee-history", "asset_assignee_history",
        datetime_cols=("assignment_start", "assignment_end", "updated_at"),
        boolean_cols=("currently_assigned",)),
    EndpointConfig(
        "asset-label-associations", "asset_label_associations",
        datetime_cols=("associated_at", "removed_at", "updated_at", "asset_label_created_at"),
        long_int_cols=("asset_label_order",),
        boolean_cols=("currently_applied", "asset_label_deactivated")),
    EndpointConfig(
        "asset-dt-codes", "asset_dt_codes",
        datetime_cols=("timestamp", "acknowledged_at", "created_at", "updated_at"),
        boolean_cols=("is_acknowledged",)),
    EndpointConfig(
        "asset-labels", "asset_labels",
        datetime_cols=("deactivated_at", "created_at", "updated_at"),
        long_int_cols=("order",),
        boolean_cols=("deactivated",)),
    EndpointConfig(
        "asset-organization-history", "asset_organization_history",
        datetime_cols=("from", "to", "updated_at"),
        boolean_cols=("currently_applied",),
        # the SQL reads from_date / to_date; the API names them from / to
        renames={"from": "from_date", "to": "to_date"}),
    EndpointConfig(
        "asset-registrations", "asset_registrations",
        datetime_cols=("expiration_date", "updated_at")),
    EndpointConfig(
        "asset-site-history", "asset_site_history",
        datetime_cols=("enter_date", "exit_date", "updated_at"),
        boolean_cols=("currently_applied",)),
    EndpointConfig(
        "asset-warranties", "asset_warranties",
        datetime_cols=("start_date", "end_value_date", "updated_at"),
        boolean_cols=("expired",)),
)

# The daily endpoints (incremental load, keep-last dedup, upsert)
DAILY_ENDPOINTS = (
    EndpointConfig(
        "asset-readings-daily", "asset_readings_daily",
        datetime_cols=("date",),
        long_int_cols=("cumulative_hours_end_of_day", "cumulative_km_end_of_day"),
        boolean_cols=("ecu_hours_provided", "ecu_odometer_provided", "ignore_ecu_hours", "ignore_ecu_odometer"),
        merge_key="asset_reading_daily_id", daily=True),
    EndpointConfig(
        "asset-utilizations-daily", "asset_utilizations_daily",
        datetime_cols=("date", "created_at", "updated_at"),
        long_int_cols=("active_run_seconds", "asset_target_work_hours", "asset_target_work_miles"),
        boolean_cols=("asset_billable",),
        merge_key=None, daily=True),
    EndpointConfig(
        "asset-site-daily-utilizations", "asset_site_daily_utilizations",
        datetime_cols=("date", "created_at", "updated_at"),
        long_int_cols=("active_run_seconds", "asset_year", "asset_target_work_hours"),
        merge_key="asset_site_daily_utilization_id", daily=True),
    EndpointConfig(
        "asset-net-working-hours-daily", "asset_net_working_hours_daily",
        datetime_cols=("date", "created_at", "updated_at"),
        long_int_cols=("total_duration_seconds", "total_idle_duration_seconds", "working_seconds",
                       "avg_daily_idle_seconds"),
        merge_key="asset_net_working_hour_daily_id", daily=True),
)

ENDPOINTS = {c.endpoint: c for c in STATIC_ENDPOINTS + DAILY_ENDPOINTS}


def endpoint_config(endpoint: str, table: str | None = None) -> EndpointConfig:
    """Registered config, or an empty one (no casts, no merge key) for an unknown endpoint."""
    if endpoint in ENDPOINTS:
        return ENDPOINTS[endpoint]
    return EndpointConfig(endpoint, table or endpoint.replace("-", "_"))


# Ids and texts of the fourteen tables (the typed columns follow from the endpoints above)
TEXT_COLS = {
    "asset_financials": ("asset_id",),
    "assets": ("asset_id", "name", "make", "model", "status"),
    "asset_assignee_history": ("asset_id", "assignee_name"),
    "asset_label_associations": ("asset_id", "asset_label_id"),
    "asset_dt_codes": ("asset_dt_code_id", "asset_id"),
    "asset_labels": ("asset_label_id", "label_name", "label_color"),
    "asset_organization_history": ("asset_id", "organization_department"),
    "asset_registrations": ("asset_id",),
    "asset_site_history": ("asset_id", "site_name"),
    "asset_warranties": ("asset_warranty_id", "asset_id"),
    "asset_readings_daily": ("asset_reading_daily_id", "asset_id"),
    "asset_utilizations_daily": ("asset_id",),
    "asset_site_daily_utilizations": ("asset_site_daily_utilization_id", "asset_id"),
    "asset_net_working_hours_daily": ("asset_net_working_hour_daily_id", "asset_id"),
}
# The shared double measures that a table is known to hold
MEASURES = {
    "asset_utilizations_daily": ("utilization_percentage", "asset_target_work_hours", "asset_target_work_miles"),
    "asset_site_daily_utilizations": ("asset_target_work_hours",),
    "asset_net_working_hours_daily": ("working_percentage",),
}


def declared_schema(cfg: EndpointConfig) -> T.StructType:
    """V6: the columns a loaded table of ``cfg`` is known to have, by their names in the table."""
    types: dict[str, T.DataType] = {c: T.StringType() for c in TEXT_COLS.get(cfg.table, ())}
    for cols, kind in ((cfg.datetime_cols, T.TimestampType()), (cfg.long_int_cols, T.LongType()), (cfg.boolean_cols, T.BooleanType()),
                       (MEASURES.get(cfg.table, ()), T.DoubleType())):
        types.update({cfg.renames.get(c, c): kind for c in cols})
    return T.StructType([T.StructField(n, k) for n, k in types.items()])


def declared_schemas() -> dict[str, T.StructType]:
    """The declared schemas of all fourteen tables."""
    return {c.table: declared_schema(c) for c in STATIC_ENDPOINTS + DAILY_ENDPOINTS}
