"""The warehouse as a lazily built graph of DataFrames.

``Warehouse(raw)`` takes the 11 raw DataFrames (from parquet files or from
the test fixture) and exposes every staging view, core table and mart as a
memoised property-like lookup: ``wh["mart_daily_kpi"]``. Nothing runs until
an action; each model is defined once, so a fact read by three marts is
one lineage (and, in :mod:`hublytics.plans.pipeline`, one written table).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hublytics.operators import core, marts, staging
from hublytics.operators.joins import BroadcastPolicy


class Warehouse:
    def __init__(self, raw: dict[str, DataFrame], as_of: Column | str | None = None,
                 quarantine_flag: str = staging.QUARANTINE_FLAG, hint: Callable | None = None,
                 sla_approx_accuracy: int | None = None, distinct_approx_rsd: float | None = None,
                 ordered_marts: bool = True):
        self.raw = raw
        if isinstance(as_of, str):
            as_of = F.lit(as_of).cast("date")
        self.as_of = as_of
        self.flag = quarantine_flag
        self.hint = hint if hint is not None else BroadcastPolicy()
        # opt-in approximate percentiles / distinct counts for very large groups
        self.sla_approx_accuracy = sla_approx_accuracy
        self.distinct_approx_rsd = distinct_approx_rsd
        self.ordered_marts = ordered_marts  # False when marts are only written (order is not kept)
        self._memo: dict[str, DataFrame] = {}
        self._overrides: dict[str, DataFrame] = {}
        self._newest: list[DataFrame | None] = []

    # ------------------------------------------------------------------ api

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._overrides:
            return self._overrides[name]
        if name not in self._memo:
            self._memo[name] = self._build(name)
        return self._memo[name]

    def replace(self, name: str, df: DataFrame) -> None:
        """Substitute a model by an equivalent DataFrame (e.g. the written
        table) so downstream models read it instead of recomputing it."""
        self._overrides[name] = df
        # everything downstream must be rebuilt on top of the replacement
        self._memo.clear()

    def newest_orders(self) -> DataFrame | None:
        """Where the newest rows of repeated order codes lie; found once."""
        if not self._newest:
            self._newest.append(staging.newest_orders(self.raw["data_shippingorder_now"], self.flag))
        return self._newest[0]

    MODELS = [
        "stg_province", "stg_district", "stg_date", "stg_warehouse", "stg_client", "stg_shipper",
        "stg_shippingorder", "stg_inside_history", "stg_transportation", "stg_shipment", "stg_cod",
        "dim_province", "dim_district", "dim_date", "dim_warehouse", "dim_client", "dim_shipper",
        "fct_shipping_order", "fct_inside_history", "fct_transportation", "fct_shipment", "fct_cod",
        "mart_daily_kpi", "mart_hub_performance", "mart_sla_breakdown", "mart_failure_reasons",
        "mart_cod_reconciliation",
    ]
    CORE = MODELS[11:22]
    MARTS = MODELS[22:]

    # ------------------------------------------------------------------ graph

    def _build(self, name: str) -> DataFrame:
        s, h = self, self.hint
        if name in staging.STAGING:
            raw_name, fn = staging.STAGING[name]
            raw = self.raw[raw_name]
            if name == "stg_shipper":
                return fn(raw, self.as_of)
            if name == "stg_shippingorder":
                return fn(raw, self.flag, self.newest_orders())
            if name.startswith("stg_") and raw_name.startswith("data_"):
                return fn(raw, self.flag)
            return fn(raw)
        builders = {
            "dim_province": lambda: core.dim_province(s["stg_province"]),
            "dim_district": lambda: core.dim_district(s["stg_district"], s["stg_province"], h),
            "dim_date": lambda: core.dim_date(s["stg_date"]),
            "dim_warehouse": lambda: core.dim_warehouse(s["stg_warehouse"], s["stg_province"], h),
            "dim_client": lambda: core.dim_client(s["stg_client"], s["stg_province"], h),
            "dim_shipper": lambda: core.dim_shipper(s["stg_shipper"], s["dim_warehouse"], s["stg_province"],
                                                    self.as_of, h),
            "fct_shipping_order": lambda: core.fct_shipping_order(s["stg_shippingorder"], s["dim_warehouse"], h),
            "fct_inside_history": lambda: core.fct_inside_history(s["stg_inside_history"]),
            "fct_transportation": lambda: core.fct_transportation(s["stg_transportation"], s["dim_warehouse"], h),
            "fct_shipment": lambda: core.fct_shipment(s["stg_shipment"], s["dim_warehouse"], h),
            "fct_cod": lambda: core.fct_cod(s["stg_cod"], s["dim_warehouse"], h),
            "mart_daily_kpi": lambda: marts.mart_daily_kpi(s["fct_shipping_order"], s["dim_date"], h),
            "mart_hub_performance": lambda: marts.mart_hub_performance(s["fct_shipping_order"],
                                                                       s["dim_warehouse"], h,
                                                                       self.distinct_approx_rsd),
            "mart_sla_breakdown": lambda: marts.mart_sla_breakdown(s["fct_shipping_order"], s["dim_date"], h,
                                                                   self.sla_approx_accuracy),
            "mart_failure_reasons": lambda: marts.mart_failure_reasons(s["fct_shipment"], self.distinct_approx_rsd,
                                                                       self.ordered_marts),
            "mart_cod_reconciliation": lambda: marts.mart_cod_reconciliation(s["fct_cod"], s["dim_date"], h),
        }
        if name not in builders:
            raise KeyError(f"unknown model {name!r}")
        return builders[name]()
