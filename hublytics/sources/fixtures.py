"""Raw parcel tables derived from the driver's TPC-H-like test tables.

The warehouse's raw layer (orders, package events, truck trips, delivery
attempts, COD records and six dimensions) is computed with Spark from
``orders``, ``lineitem``, ``customer``, ``supplier``, ``nation``,
``region`` and ``events``, by key arithmetic only (no random numbers), so
an independent SQL engine can rebuild exactly the same rows. The rules put
"dirt" into the data on purpose (padded text, NaN ids, bad dates, enum
drift, duplicates, quarantine flags) so the cleaning layer has work to do.

Sizes grow with the inputs: every table here is a projection, filter,
aggregate or ``explode`` of a given table. Counts that parameterise the
arithmetic (number of suppliers, shippers and orders) are uncorrelated
scalar subqueries, evaluated once by Spark, never collected by Python.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hublytics.functions.semantics import ACTION_NAMES, add_hours, volumetric_weight
from hublytics.operators.derive import build_calendar, cod_adjustments, collected_amount, trip_rollup

TEST_TABLES = ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]

# Fixed values used by the fixture rules.
FAILURE_REASONS = ["wrong_address", "not_home", "refused", "damaged", "other"]
FIXED_HOLIDAYS_MMDD = ["01-01", "04-30", "05-01", "09-02"]
# Day texts in the order in which they are planted: read or not read by rule.
DAY_TEXTS = ["1999/1/2 3:04", "1999-01-02 03:04:05 ", " 1999 01 02", "1999-01/02", "1999-01-02Tjunk", "1999-01-02T03:04:05.25Z",
             "1999-01-02 abc", "1999-01-02 24:00:00"]


def load_testdata(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet")) for t in TEST_TABLES}


def _pick(index: Column, values: list[str]) -> Column:
    """values[index] for a 0-based integer column (CASE chain, codegen-friendly)."""
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def _code(prefix: str, key: Column, width: int = 8) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))


def _nan() -> Column:
    return F.lit(float("nan")).cast("double")


def _ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def _drifted(day: Column, index: Column) -> Column:
    """A day as text: mostly ISO, for a few values of ``index`` in other forms."""
    form = lambda f, end="": F.concat(F.date_format(day, f), F.lit(end))
    return (F.when(index == 1, form("yyyy/MM/dd")).when(index == 2, form("yyyy MM dd")).when(index == 3, form("yyyy\\MM\\dd"))
            .when(index == 4, form("yyyy-M-d", " ")).when(index == 5, form("yyyy-MM-dd", " abc")).when(index == 6, form("yyyy-MM/dd"))
            .when(index == 7, form("yyyy-MM-dd HH:mm")).otherwise(form("yyyy-MM-dd")))


class Fixture:
    """Lazily derived raw tables for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = load_testdata(spark, sf_dir)
        # scalar subqueries: evaluated by Spark inside the plans that use them
        self.n_wh = self.t["supplier"].select(F.count(F.lit(1))).scalar()
        self.n_sh = self.t["customer"].select(F.count(F.lit(1))).scalar()
        self.n_orders = self.t["orders"].select(F.count(F.lit(1))).scalar()

    # ------------------------------------------------------------ dimensions

    def dim_province(self) -> DataFrame:
        n, r = self.t["nation"], self.t["region"]
        return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
                .select(
                    (F.col("n_nationkey") + 1).cast("long").alias("province_id"),
                    F.when(F.col("n_nationkey") % 7 == 0, F.concat(F.lit("  "), F.col("n_name"), F.lit(" ")))
                     .otherwise(F.col("n_name")).alias("province_name"),
                    F.col("r_name").alias("region"),
                    F.col("n_regionkey").cast("int").alias("region_idx")))

    def dim_district(self) -> DataFrame:
        n = self.t["nation"].select("n_nationkey", "n_name",
                                    F.explode(F.sequence(F.lit(0), F.lit(3))).alias("i"))
        return n.select(
            (F.lit(10001) + 4 * F.col("n_nationkey") + F.col("i")).cast("long").alias("district_id"),
            F.when(F.col("i") == 3, F.concat(F.lit("District "), F.col("n_nationkey").cast("string"),
                                              F.lit("-"), F.col("i").cast("string"), F.lit(" ")))
             .otherwise(F.concat(F.lit("District "), F.col("n_nationkey").cast("string"),
                                 F.lit("-"), F.col("i").cast("string"))).alias("district_name"),
            (F.col("n_nationkey") + 1).cast("long").alias("province_id"),
            F.col("n_name").alias("province_name"))

    def dim_date(self) -> DataFrame:
        bounds = self.t["orders"].agg(
            F.min(F.to_date("o_orderdate")).alias("start"),
            F.max(F.to_date("o_orderdate")).alias("end"))
        return build_calendar(bounds, FIXED_HOLIDAYS_MMDD)

    def dim_warehouse(self) -> DataFrame:
        s, n, r = self.t["supplier"], self.t["nation"], self.t["region"]
        k = F.col("s_suppkey")
        geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
        return (s.join(geo, s.s_nationkey == geo.n_nationkey, "left")
                .select(
                    (k + 2001).cast("long").alias("warehouse_id"),
                    F.when(k % 20 == 0, F.concat(F.col("s_name"), F.lit(" "))).otherwise(F.col("s_name"))
                     .alias("warehouse_name"),
                    F.when(k < 8, F.lit("KTC")).otherwise(F.lit("BC")).alias("warehouse_type"),
                    F.when(k % 25 == 0, _nan())
                     .otherwise((F.lit(10001) + 4 * F.col("s_nationkey")).cast("double")).alias("district_id"),
                    (F.col("s_nationkey") + 1).cast("long").alias("province_id"),
                    F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("province_name"),
                    F.substring(F.col("r_name"), 1, 3).alias("region_shortname"),
                    F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("region_fullname"),
                    F.when(k % 33 == 0, F.lit(0.0)).otherwise(F.lit(8.0) + (k % 15).cast("double") * 0.5)
                     .alias("latitude"),
                    F.when(k % 33 == 0, F.lit(0.0)).otherwise(F.lit(102.0) + (k % 13).cast("double") * 0.5)
                     .alias("longitude"),
                    (k % 17 != 0).alias("is_enabled"),
                    (k % 23 == 0).alias("is_virtual"),
                    add_hours(_ntz(F.lit("2020-01-01 00:00:00")), k).alias("created_time")))

    def _client_base(self) -> DataFrame:
        c = self.t["customer"]
        k = F.col("c_custkey")
        seg = F.col("c_mktsegment")
        bal = F.col("c_acctbal")
        tier = (F.when(bal < 0, "Bronze").when(bal < 3000, "Silver")
                .when(bal < 7000, "Gold").otherwise("Diamond"))
        return c.select(
            (k + 1).cast("long").alias("client_id"),
            (k + 100001).cast("long").alias("shop_id"),
            (F.when(seg == "AUTOMOBILE", "SHOPEE").when(seg == "BUILDING", "SME")
             .when(seg == "FURNITURE", " TTS ").when(seg == "HOUSEHOLD", "lazada")
             .otherwise(F.lit(None).cast("string"))).alias("client_type"),
            (F.col("c_nationkey") + 1).cast("long").alias("province_id"),
            (F.lit(10001) + 4 * F.col("c_nationkey") + k % 4).cast("long").alias("district_id"),
            (k % 20 < 3).alias("is_b2b"),
            F.date_add(F.lit("1994-01-01").cast("date"), (k % 365).cast("int")).alias("created_date"),
            F.when(k % 13 == 0, F.concat(tier, F.lit(" "))).otherwise(tier).alias("tier"),
            F.when(seg == "MACHINERY", "light_issue").otherwise("clean").alias("_data_quality"),
            k.alias("_k"))

    def dim_client(self) -> DataFrame:
        return self._client_base().drop("_k")

    def dim_client_changed(self) -> DataFrame:
        """Second day of the client dimension (for SCD2): some tiers move up,
        some clients disappear, some new clients appear."""
        base = self._client_base()
        k = F.col("_k")
        changed = (base.filter(k % 50 != 1)
                   .withColumn("tier", F.when(k % 10 == 0, F.lit("Diamond")).otherwise(F.col("tier"))))
        added = (base.filter(k % 100 == 2)
                 .withColumn("client_id", F.col("client_id") + 1000000))
        return changed.unionByName(added).drop("_k")

    def dim_shipper(self) -> DataFrame:
        c = self.t["customer"]
        k = F.col("c_custkey")
        sid = (k + 1).cast("long")
        hire_future = k % 500 == 0
        plate_null = k % 70 == 0
        weight_null = k % 90 == 0
        return c.select(
            sid.alias("shipper_id"),
            _code("U", sid, 6).alias("user_id"),
            (F.lit(2001) + k % self.n_wh).cast("long").alias("warehouse_id"),
            (F.col("c_nationkey") + 1).cast("long").alias("province_id"),
            F.when(hire_future, F.lit("2999-01-01").cast("date"))
             .otherwise(F.date_add(F.lit("1994-01-01").cast("date"), (k % 400).cast("int"))).alias("hire_date"),
            (k % 30 != 0).alias("is_active"),
            _pick(k % 3, ["A", "B", "C"]).alias("performance_tier"),
            F.when(plate_null, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit(" 29h - "), F.lpad((k % 100000).cast("string"), 5, "0")))
             .alias("truck_plate_number"),
            F.when(weight_null, F.lit(None).cast("double"))
             .otherwise(F.lit(500.0) + (k % 4).cast("double") * 250.0).alias("vehicle_weight_kg"),
            F.when(hire_future, "heavy_issue").when(plate_null | weight_null, "light_issue")
             .otherwise("clean").alias("_data_quality"))

    # ------------------------------------------------------------ facts

    def _order_created(self, k: Column) -> Column:
        return add_hours(_ntz(F.col("o_orderdate")), F.lit(6) + k % 16, k % 60)

    def _order_deliver_wh(self, k: Column) -> Column:
        return F.when(k % 151 == 0, F.lit(None).cast("long")).otherwise(
            (F.lit(2001) + (k * 13) % self.n_wh).cast("long"))

    def data_shippingorder_now(self) -> DataFrame:
        o = self.t["orders"]
        k = F.col("o_orderkey")
        m25 = k % 25
        created = self._order_created(k)
        first_del = add_hours(created, F.lit(13) + k % 77)
        status = (F.when(k % 300 == 1, "DONE").when(k % 300 == 2, " Finish ").when(k % 997 == 5, " LOST ")
                  .when(m25 < 18, F.when(k % 7 == 0, "Delivered").otherwise("delivered"))
                  .when(m25 == 18, "return_to_sender").when(m25 == 19, "Returned")
                  .when(m25 == 20, "canceled").when(m25 == 21, "ready_to_pick")
                  .when(m25 == 22, "picking").when(m25 == 23, "in_transit").otherwise("delivering"))
        reason = _pick(k % 5, FAILURE_REASONS)
        failure = (F.when(m25.isin(18, 19), F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(reason))
                   .when(k % 600 == 4, F.lit(" not_home ")))
        cod = (F.when(k % 1000 == 3, F.lit(-50000).cast("long"))
               .when(k % 5 < 3, F.floor(F.col("o_totalprice")).cast("long")).otherwise(F.lit(0).cast("long")))
        weight = (F.when(k % 125 == 0, F.lit(0).cast("long")).when(k % 2000 == 1, F.lit(250000).cast("long"))
                  .otherwise((F.lit(10) + (k * 37) % 30000).cast("long")))
        length, width, height = (F.lit(5) + k % 75).cast("long"), (F.lit(5) + k % 55).cast("long"), \
            (F.lit(2) + k % 48).cast("long")
        dt = F.to_date(created)
        base = o.select(
            F.concat(F.lit(" ORD"), F.lpad(k.cast("string"), 8, "0")).alias("order_code"),
            F.concat(F.lit("Shop "), F.col("o_custkey").cast("string")).alias("from_name"),
            F.concat(F.lit("09"), F.lpad(((k * 7919) % 100000000).cast("string"), 8, "0")).alias("from_phone"),
            F.concat(F.lit("No. "), (k % 300).cast("string"), F.lit(" Street")).alias("from_address"),
            F.when(k % 9 == 0, F.lit("  ")).otherwise(F.concat(F.lit("W"), (k % 50).cast("string")))
             .alias("from_ward_code"),
            F.concat(F.lit("09"), F.lpad(((k * 104729) % 100000000).cast("string"), 8, "0")).alias("to_phone"),
            F.concat(F.lit("W"), ((k * 3) % 50).cast("string"), F.lit(" ")).alias("to_ward_code"),
            _pick(k % 4, ["clothes", " shoes ", "", "books"]).alias("content"),
            F.when(k % 10 == 0, F.lit("call first")).alias("note"),
            _pick(k % 3, ["app", "web ", "api"]).alias("created_source"),
            status.alias("status"),
            _pick(k % 3, [" morning", "afternoon", "evening "]).alias("deliver_shift"),
            F.when(k % 2 == 0, F.lit("normal")).otherwise(F.lit(" express")).alias("type_order"),
            F.when(k % 71 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("TC"), (F.lit(1) + k % 9).cast("string"))).alias("type_order_code"),
            failure.alias("failure_reason"),
            F.when(k % 7 == 0, F.lit("bad")).when(k % 70 < 8, _pick(k % 70, DAY_TEXTS))
             .when(k % 5 < 3, F.lit("1999-01-02 03:04:05")).alias("cod_collect_date"),
            (F.col("o_custkey") + 100001).cast("long").alias("shop_id"),
            (F.col("o_custkey") + 1).cast("long").alias("client_id"),
            (F.lit(10001) + k % 100).cast("long").alias("from_district_id"),
            (F.lit(10001) + (k * 7) % 100).cast("long").alias("to_district_id"),
            weight.alias("weight"),
            length.alias("length"), width.alias("width"), height.alias("height"),
            volumetric_weight(weight, length, width, height).alias("converted_weight"),
            F.when(k % 5 < 3, F.lit(2)).otherwise(F.lit(5)).cast("long").alias("service_type_id"),
            (F.lit(53320) + k % 3).cast("long").alias("service_id"),
            cod.alias("cod_amount"),
            F.when(k % 3 == 0, F.floor(F.col("o_totalprice")).cast("long")).otherwise(F.lit(0).cast("long"))
             .alias("insurance_value"),
            (F.lit(100) + k % 20).cast("long").alias("pick_station_id"),
            (F.lit(2001) + (k * 7) % self.n_wh).cast("long").alias("pick_warehouse_id"),
            self._order_deliver_wh(k).alias("deliver_warehouse_id"),
            (F.lit(2001) + (k * 17) % self.n_wh).cast("long").alias("current_warehouse_id"),
            F.when(k % 211 == 0, _nan()).otherwise((F.lit(2001) + (k * 19) % self.n_wh).cast("double"))
             .alias("return_warehouse_id"),
            F.when(k % 83 == 0, F.lit(None).cast("long")).otherwise((F.lit(1) + (k * 3) % self.n_sh).cast("long"))
             .alias("pick_user"),
            F.when(k % 33 == 0, F.lit(None).cast("long")).otherwise((F.lit(1) + k % self.n_sh).cast("long"))
             .alias("deliver_user"),
            F.when(m25.isin(18, 19), (F.lit(1) + (k * 5) % self.n_sh).cast("double"))
             .when(k % 301 == 0, _nan()).alias("return_user"),
            F.when(m25 == 18, cod).otherwise(F.lit(0).cast("long")).alias("cod_failed_amount"),
            created.alias("created_date"),
            add_hours(created, F.lit(2) + k % 5).alias("end_pick_time"),
            first_del.alias("first_delivered_time"),
            F.when(k % 333 == 0, add_hours(created, -5)).otherwise(add_hours(first_del, k % 24))
             .alias("end_delivery_time"),
            dt.alias("dt"),
            (F.year(dt) * 10000 + F.month(dt) * 100 + F.dayofmonth(dt)).cast("int").alias("date_id"),
            (k % 20 < 3).alias("is_b2b"),
            F.when(k % 50 == 5, F.lit(None).cast("boolean")).otherwise(k % 12 == 0).alias("is_sla_breach"),
            F.when(k % 97 == 0, F.lit(None).cast("string")).when(k % 40 == 0, "heavy_issue")
             .when(k % 11 == 0, "light_issue").otherwise("clean").alias("_data_quality"),
            k.alias("_k"))
        dups = (base.filter(F.col("_k") % 400 == 7)
                .withColumn("created_date", add_hours(F.col("created_date"), 1))
                .withColumn("status", F.lit("cancel")))
        copies = base.filter(F.col("_k") % 400 == 11)  # whole rows again
        return base.unionByName(dups).unionByName(copies).drop("_k")

    def data_inside_history(self) -> DataFrame:
        ev = self.t["events"]
        e = F.col("event_id")
        ord_k = (e * 3) % self.n_orders
        et = F.col("event_type")
        cat = (F.when(et == "view", "receive").when(et == "click", "pack")
               .when(et == "purchase", "export").when(et == "signup", "unpack")
               .otherwise(F.lit(None).cast("string")))
        # three destinations for each hub; what an event says of its trip's hubs can be
        # missing, NaN or wrong, and every third event's time is that of its hour
        route_from = F.lit(2001) + e % self.n_wh
        route_to = F.when(e % 89 == 0, F.lit(999999)).otherwise(F.lit(2001) + (e + 1 + F.floor(e / 7) % 3) % self.n_wh)
        from_w = F.when(e % 97 == 0, F.lit(None).cast("double")).when(e % 37 == 0, _nan()).otherwise(route_from.cast("double"))
        to_w = F.when(e % 41 == 0, _nan()).when(e % 43 == 0, F.lit(None).cast("double")) \
            .when(e % 13 == 0, F.lit(2001) + e % 5).otherwise(route_to.cast("double"))
        ts = _ntz(F.when(e % 3 == 0, F.date_trunc("hour", F.col("ts").cast("timestamp"))).otherwise(F.col("ts").cast("timestamp")))
        wh = (F.when(e % 20 == 0, _nan()).when(e % 19 == 0, F.lit(None).cast("double"))
              .when(cat == "receive", to_w).otherwise(from_w))
        names = None
        for key, val in ACTION_NAMES.items():
            names = F.when(cat == key, val) if names is None else names.when(cat == key, val)
        return ev.select(
            F.when(e % 500 == 0, F.lit("bad-date")).otherwise(_drifted(ts, e % 100)).alias("dt"),
            ts.alias("action_time"),
            cat.alias("action_category"),
            names.alias("action_name"),
            _code("P", ord_k).alias("package_code"),
            F.concat(F.lit(" ORD"), F.lpad(ord_k.cast("string"), 8, "0")).alias("order_code"),
            wh.alias("warehouse_id"),
            from_w.alias("from_warehouse_id"),
            to_w.alias("to_warehouse_id"),
            F.when(cat == "export", F.concat(F.lit("T"), F.date_format(ts, "yyyyMM"), F.lit("-"), route_from.cast("string"),
                                             F.lit("-"), route_to.cast("string"))).alias("trip_code"),
            F.lit(None).cast("string").alias("trip_partner"),
            F.lit(None).cast("string").alias("stop_code"),
            F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("session_code"),
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user_id"),
            F.concat(F.lit(" user "), F.col("user_id").cast("string")).alias("user_name"),
            F.when(cat.isNull(), "heavy_issue").when(wh.isNull() | F.isnan(wh), "light_issue")
             .otherwise("clean").alias("_data_quality"))

    def data_transportation(self) -> DataFrame:
        trips = trip_rollup(self.data_inside_history())
        n = F.col("n_packages")
        dep = F.col("departure_time")
        arr = F.when(F.dayofmonth(dep) == 13, add_hours(dep, -1)).otherwise(add_hours(dep, F.lit(2) + n % 18))
        weight_null = n % 7 == 0
        return trips.select(
            "trip_code", "from_warehouse_id", "to_warehouse_id",
            dep.alias("departure_time"),
            arr.alias("arrival_time"),
            (F.lit(1) + n % self.n_sh).cast("long").alias("driver_id"),
            F.concat(F.lit(" 51c "), F.lpad(F.col("from_warehouse_id").cast("long").cast("string"), 5, "0"))
             .alias("truck_plate_number"),
            F.when(weight_null, F.lit(None).cast("double")).otherwise(F.lit(1500.0) + (n % 3).cast("double") * 500.0)
             .alias("vehicle_weight_kg"),
            n.alias("n_packages"),
            F.date_format(dep, "yyyy-MM-dd").alias("dt"),
            F.when(arr < dep, "heavy_issue")
             .when(weight_null | (F.col("from_warehouse_id") == F.col("to_warehouse_id")), "light_issue")
             .otherwise("clean").alias("_data_quality"))

    def data_shipment(self) -> DataFrame:
        li = self.t["lineitem"]
        ok, ln, pk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
        rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
        sid = (F.lit(1) + (ok + ln) % self.n_sh).cast("long")
        failed = rf == "R"
        reason = F.when(failed & (pk % 200 != 0), _pick(pk % 5, FAILURE_REASONS))
        wh = F.when(pk % 130 == 0, _nan()).otherwise((F.lit(2001) + F.col("l_suppkey") % self.n_wh).cast("double"))
        when_at = add_hours(_ntz(F.col("l_shipdate")), F.lit(8) + pk % 12)
        return li.select(
            F.concat(F.lit("L"), ok.cast("string"), F.lit("-"), ln.cast("string")).alias("trip_code"),
            F.concat(F.lit(" ORD"), F.lpad(ok.cast("string"), 8, "0")).alias("order_code"),
            ln.cast("int").alias("attempt_no"),
            sid.alias("shipper_id"),
            _code("U", sid, 6).alias("shipper_user_id"),
            wh.alias("deliver_warehouse_id"),
            _pick(ln % 3, [" morning", "afternoon", "evening "]).alias("deliver_shift"),
            (F.when(failed, " FAILED ").when(rf == "A", "success")
             .when(ls == "O", "pending").otherwise("In_Progress")).alias("attempt_status"),
            F.when(failed, "fail").when(rf == "A", "ok").alias("attempt_result"),
            reason.alias("failure_reason"),
            when_at.alias("deliver_time"),
            F.date_format(when_at, "yyyy-MM-dd").alias("dt"),
            F.when(failed & reason.isNull(), "heavy_issue").when(pk % 130 == 0, "light_issue")
             .otherwise("clean").alias("_data_quality"))

    def data_cod(self) -> DataFrame:
        o = self.t["orders"].filter(F.col("o_orderkey") % 5 < 3)
        k = F.col("o_orderkey")
        m = k % 20
        cod = F.floor(F.col("o_totalprice")).cast("double")
        status = (F.when(m.isin(15, 16), "failed").when(m.isin(12, 17), "pending")
                  .when(m == 11, "transferred").otherwise("collected"))
        collect = add_hours(self._order_created(k), k % 72)
        clean = o.select(
            (k + 1).cast("long").alias("cod_id"),
            F.concat(F.lit(" ORD"), F.lpad(k.cast("string"), 8, "0")).alias("order_code"),
            self._order_deliver_wh(k).alias("warehouse_id"),
            cod.alias("cod_amount"),
            collected_amount(status, cod, F.lit(0.5) * cod + F.lit(0.25)).alias("collected_amount"),
            status.alias("cod_status"),
            (F.when(k % 400 == 10, "manual_review").when(m.isin(15, 17), "discrepancy")
             .when(m == 16, " Pending ").otherwise("RECONCILED")).alias("reconcile_status"),
            collect.alias("collect_time"),
            F.when(status == "transferred", add_hours(collect, F.lit(24) + k % 48)).alias("transfer_time"),
            _drifted(collect, k % 50).alias("dt"),
            F.lit("clean").alias("_data_quality"),
            k.alias("_k"))
        # a few records state a difference that their amounts do not have
        wrong = F.when(F.col("_k") % 500 == 10, 7.0).otherwise(0.0)
        clean = clean.withColumn("discrepancy_amount", F.col("cod_amount") - F.col("collected_amount") + wrong)
        with_adj = cod_adjustments(clean)
        # dirt on the original records only; adjustments stay clean
        orig = F.col("cod_status") != "adjustment"
        kk = F.col("_k")
        cod_null = orig & (kk % 211 == 3)
        neg = orig & (kk % 300 == 5)
        time_null = orig & (kk % 67 == 0)
        out = with_adj.select(
            "cod_id", "order_code", "warehouse_id",
            F.when(cod_null, F.lit(None).cast("double")).otherwise(F.col("cod_amount")).alias("cod_amount"),
            F.when(neg, -F.col("collected_amount")).otherwise(F.col("collected_amount")).alias("collected_amount"),
            "discrepancy_amount",
            F.when(orig & (kk % 9 == 0), F.concat(F.lit(" "), F.upper("cod_status"), F.lit(" ")))
             .otherwise(F.col("cod_status")).alias("cod_status"),
            "reconcile_status",
            F.when(time_null, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("collect_time"))
             .alias("collect_time"),
            "transfer_time",
            F.when(time_null, F.lit(None).cast("string")).otherwise(F.col("dt")).alias("dt"),
            F.when(cod_null | neg, "heavy_issue")
             .when(time_null | (F.col("reconcile_status") == "manual_review"), "light_issue")
             .otherwise(F.col("_data_quality")).alias("_data_quality"))
        return out

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_province": self.dim_province(),
            "dim_district": self.dim_district(),
            "dim_date": self.dim_date(),
            "dim_warehouse": self.dim_warehouse(),
            "dim_client": self.dim_client(),
            "dim_shipper": self.dim_shipper(),
            "data_shippingorder_now": self.data_shippingorder_now(),
            "data_inside_history": self.data_inside_history(),
            "data_transportation": self.data_transportation(),
            "data_shipment": self.data_shipment(),
            "data_cod": self.data_cod(),
        }


def fixture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return Fixture(spark, sf_dir).tables()
