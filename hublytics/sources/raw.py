"""Raw-layer sources: the 11 parquet tables and the two CSV seeds."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_TABLES = [
    "dim_province", "dim_district", "dim_date", "dim_warehouse", "dim_client",
    "dim_shipper", "data_shippingorder_now", "data_inside_history",
    "data_transportation", "data_shipment", "data_cod",
]

# Timestamp columns per raw table. Files written by pandas carry
# TIMESTAMP(NANOS), which Spark reads as LONG nanoseconds under
# spark.sql.legacy.parquet.nanosAsLong; those are converted back here.
TIMESTAMP_COLUMNS = {
    "dim_warehouse": ["created_time"],
    "data_shippingorder_now": ["created_date", "end_pick_time", "first_delivered_time",
                               "end_delivery_time"],
    "data_inside_history": ["action_time"],
    "data_transportation": ["departure_time", "arrival_time"],
    "data_shipment": ["deliver_time"],
    "data_cod": ["collect_time", "transfer_time"],
}


# Declared columns of the raw tables, by kind of value. A kind admits every type
# that the cleaning layer reads as that kind (a whole number with gaps arrives as
# DOUBLE); any other type is a finding and is converted value by value.
RAW_COLUMNS = {
    "dim_province": {"whole": "province_id region_idx", "text": "province_name region"},
    "dim_district": {"whole": "district_id province_id", "text": "district_name province_name"},
    "dim_date": {"whole": "date_id year quarter month week_of_year day_of_week", "day": "date", "text": "day_of_week_vn",
                 "flag": "is_weekend is_holiday_vn"},
    "dim_warehouse": {"whole": "warehouse_id district_id province_id", "number": "latitude longitude", "flag": "is_enabled is_virtual",
                      "text": "warehouse_name warehouse_type province_name region_shortname region_fullname", "time": "created_time"},
    "dim_client": {"whole": "client_id shop_id province_id district_id", "text": "client_type tier _data_quality", "flag": "is_b2b",
                   "day": "created_date"},
    "dim_shipper": {"whole": "shipper_id warehouse_id province_id", "text": "user_id performance_tier truck_plate_number _data_quality",
                    "day": "hire_date", "flag": "is_active", "number": "vehicle_weight_kg"},
    "data_shippingorder_now": {
        "text": "order_code from_name from_phone from_address from_ward_code to_phone to_ward_code content note created_source status "
                "deliver_shift type_order type_order_code failure_reason cod_collect_date _data_quality",
        "whole": "shop_id client_id from_district_id to_district_id weight length width height converted_weight service_type_id "
                 "service_id cod_amount insurance_value pick_station_id pick_warehouse_id deliver_warehouse_id current_warehouse_id "
                 "return_warehouse_id pick_user deliver_user return_user cod_failed_amount date_id",
        "time": "created_date end_pick_time first_delivered_time end_delivery_time", "day": "dt", "flag": "is_b2b is_sla_breach"},
    "data_inside_history": {
        "text": "dt action_category action_name package_code order_code trip_code trip_partner stop_code session_code user_id user_name "
                "_data_quality", "time": "action_time", "number": "warehouse_id from_warehouse_id to_warehouse_id"},
    "data_transportation": {"text": "trip_code truck_plate_number dt _data_quality", "number": "from_warehouse_id to_warehouse_id "
                            "vehicle_weight_kg", "time": "departure_time arrival_time", "whole": "driver_id n_packages"},
    "data_shipment": {"text": "trip_code order_code shipper_user_id deliver_shift attempt_status attempt_result failure_reason dt "
                      "_data_quality", "whole": "attempt_no shipper_id", "number": "deliver_warehouse_id", "time": "deliver_time"},
    "data_cod": {"whole": "cod_id warehouse_id", "text": "order_code cod_status reconcile_status dt _data_quality",
                 "number": "cod_amount collected_amount discrepancy_amount", "time": "collect_time transfer_time"},
}

_WHOLE = {"tinyint", "smallint", "int", "bigint"}
#: kind -> (types it admits, type that other values are converted to)
KINDS = {
    "whole": (_WHOLE | {"double", "float"}, "bigint"),
    "number": (_WHOLE | {"double", "float"}, "double"),
    "text": ({"string"}, "string"),
    "time": ({"timestamp", "timestamp_ntz", "bigint"}, "timestamp_ntz"),  # bigint: nanoseconds
    "day": ({"date", "timestamp", "timestamp_ntz"}, "date"),
    "flag": ({"boolean"}, "boolean"),
}

DRIFT_SCHEMA = "table_name string, column_name string, finding string, declared string, found string"


def declared(name: str) -> dict[str, str]:
    """Column -> kind of a raw table."""
    return {c: kind for kind, columns in RAW_COLUMNS[name].items() for c in columns.split()}


def drift(name: str, df: DataFrame) -> list[tuple]:
    """How the columns of ``df`` depart from the declared ones: rows of
    DRIFT_SCHEMA with the findings missing, extra, type."""
    found, want = dict(df.dtypes), declared(name)
    # an all-NULL column of a writer without types arrives as VOID or INT: it holds nothing to convert
    out = [(name, c, "missing", kind, None) for c, kind in want.items() if c not in found]
    out += [(name, c, "type", kind, found[c]) for c, kind in want.items() if c in found and found[c] not in KINDS[kind][0]]
    return out + [(name, c, "extra", None, t) for c, t in found.items() if c not in want]


def as_declared(name: str, df: DataFrame) -> DataFrame:
    """``df`` with every declared column: a missing one is NULL, one of another
    type is converted value by value (what cannot be is NULL). Columns beyond
    the declared ones stay, behind them."""
    wrong = {c: (kind, finding) for _, c, finding, kind, _ in drift(name, df) if finding != "extra"}
    if not wrong:
        return df

    def column(c: str) -> Column:
        kind, finding = wrong[c]
        return F.lit(None).cast(KINDS[kind][1]) if finding == "missing" else F.col(f"`{c}`").try_cast(KINDS[kind][1])

    return df.withColumns({c: column(c) for c in wrong})


def schema_drift(spark: SparkSession, root: str) -> DataFrame:
    """The findings of all raw tables under ``root``; reads schemas only."""
    rows = [r for name in RAW_TABLES for r in drift(name, spark.read.parquet(os.path.join(root, f"{name}.parquet")))]
    return spark.createDataFrame(rows, DRIFT_SCHEMA)


def nanos_to_timestamp(df: DataFrame, columns: list[str]) -> DataFrame:
    """LONG epoch nanoseconds -> TIMESTAMP_NTZ (UTC session zone), in whole
    microseconds (rounded down), by integer division."""
    fixes = {}
    types = dict(df.dtypes)
    for c in columns:
        if types.get(c) in ("bigint", "int"):
            fixes[c] = F.timestamp_micros(F.expr(f"(`{c}` - pmod(`{c}`, 1000)) div 1000")).cast("timestamp_ntz")
        elif types.get(c) == "timestamp":
            fixes[c] = F.col(c).cast("timestamp_ntz")
    return df.withColumns(fixes) if fixes else df


def read_raw(spark: SparkSession, root: str, name: str,
             columns: list[str] | None = None) -> DataFrame:
    """Scan ``{root}/{name}.parquet`` as declared (:func:`as_declared`);
    ``columns`` prunes the scan."""
    df = as_declared(name, spark.read.parquet(os.path.join(root, f"{name}.parquet")))
    if columns:
        df = df.select(*columns)
    return nanos_to_timestamp(df, [c for c in TIMESTAMP_COLUMNS.get(name, []) if c in df.columns])


def read_raw_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_raw(spark, root, name) for name in RAW_TABLES}


SEED_DIR = os.path.join(os.path.dirname(__file__), "seeds")

SEED_SCHEMAS = {
    "seed_status_mapping": T.StructType([
        T.StructField("status", T.StringType()),
        T.StructField("status_label_vn", T.StringType()),
        T.StructField("outcome_group", T.StringType()),
        T.StructField("is_terminal", T.BooleanType()),
    ]),
    "seed_sla_threshold": T.StructType([
        T.StructField("service_code", T.StringType()),
        T.StructField("service_label_vn", T.StringType()),
        T.StructField("sla_target_hours", T.IntegerType()),
        T.StructField("region_scope", T.StringType()),
    ]),
}


def read_seed(spark: SparkSession, name: str, seed_dir: str = SEED_DIR) -> DataFrame:
    """Typed CSV seed with a header row."""
    return (spark.read.option("header", True).option("encoding", "UTF-8")
            .schema(SEED_SCHEMAS[name]).csv(os.path.join(seed_dir, f"{name}.csv")))
