"""Domain tables derived from the driver's tables, whole and lazily.

Orders and lines stand for the trade side, events for the log and the interaction side, parts for products,
customers for users, nations and regions for provinces, suppliers for promotions and activities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.functions.columns import MONEY, money
from martline.functions.dates import shift

ORDER_DAY = "1998-06-01"
EVENT_DAY = "2024-01-30"
FINISH_SECONDS = 5 * 86400


class Standins:
    """The stand-ins of one scale directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # Trade

    def orders(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Orders of a day range; the range is a predicate on the stored column and reaches the scan."""
        rows = self.table("orders")
        if first is not None:
            rows = rows.where(F.col("o_orderdate") >= F.lit(first).cast("timestamp_ntz"))
        if last is not None:
            rows = rows.where(F.col("o_orderdate") < F.lit(shift(last, 1)).cast("timestamp_ntz"))
        return rows

    def headers(self, first: str | None = None, last: str | None = None, province: bool = True) -> DataFrame:
        """Orders with their text columns made once per order, and their customer's nation where asked for."""
        rows = self.orders(first, last).select(
            "*", _text("o_orderkey").alias("order_id"), _text("o_custkey").alias("user_id"),
            _day("o_orderdate").alias("day"), _time("o_orderdate").alias("order_time"),
        )
        if not province:
            return rows
        customer = self.table("customer").select("c_custkey", _text("c_nationkey").alias("province_id"))
        return rows.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")

    def lines(self, first: str | None = None, last: str | None = None, province: bool = False) -> DataFrame:
        return self.table("lineitem").join(
            self.headers(first, last, province), F.col("l_orderkey") == F.col("o_orderkey")
        )

    def order_detail(
        self, first: str | None = None, last: str | None = None, province: bool = False
    ) -> DataFrame:
        """Order lines in the shape of the order detail fact, with the province where it is asked for."""
        original = money("l_extendedprice")
        cut = money(original * F.col("l_discount").cast("decimal(4,2)"))
        by_activity = F.col("l_discount") >= F.lit(0.05)
        none = F.lit(0).cast(MONEY)
        return self.lines(first, last, province).select(
            _line_id().alias("id"), "order_id", "user_id", _text("l_partkey").alias("sku_id"),
            *(["province_id"] if province else []), F.col("day").alias("date_id"),
            F.col("l_quantity").cast("bigint").alias("sku_num"), original.alias("split_original_amount"),
            F.when(by_activity, cut).otherwise(none).alias("split_activity_amount"),
            F.when(by_activity, none).otherwise(cut).alias("split_coupon_amount"),
            (original - cut).cast(MONEY).alias("split_total_amount"), F.col("day").alias("dt"),
        )

    def order_feeds(
        self, kind: str, first: str | None = None, last: str | None = None
    ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """Detail, header, coupon and activity feeds of the orders as changes of type ``kind``.

        Every change is filed under its order day; a bootstrap copy is filed under one day.
        """
        whole = kind == "bootstrap-insert" and first is None and last is None
        # A whole bootstrap copy is filed under one day, so its lines need nothing from their orders.
        joined = self.table("lineitem").withColumn("order_id", _text("l_orderkey")) if whole else self.lines(first, last)
        dt = F.lit(ORDER_DAY) if kind == "bootstrap-insert" else F.col("day")
        original = money("l_extendedprice")
        cut = money(original * F.col("l_discount").cast("decimal(4,2)"))
        activity = F.col("l_discount") >= F.lit(0.05)
        details = joined.select(
            *_envelope(
                kind,
                _line_id().alias("id"), "order_id", _text("l_partkey").alias("sku_id"),
                money("l_extendedprice").alias("order_price"), F.col("l_quantity").cast("bigint").alias("sku_num"),
                money(original - cut).alias("split_total_amount"),
                F.when(activity, cut).alias("split_activity_amount"),
                F.when(~activity, cut).alias("split_coupon_amount"),
            ),
            dt.alias("dt"),
        )
        headers = self.headers(first, last).select(
            *_envelope(
                kind,
                F.col("order_id").alias("id"), "user_id", "province_id", F.col("order_time").alias("create_time"),
                money("o_totalprice").alias("original_total_amount"),
                F.lit(None).cast(MONEY).alias("activity_reduce_amount"),
                money(F.lit(1)).alias("coupon_reduce_amount"),
                money("o_totalprice").alias("total_amount"),
            ),
            dt.alias("dt"),
        )
        line_keys = [_line_id().alias("order_detail_id")]
        coupons = joined.where((F.col("l_discount") > 0) & ~activity).select(
            *_envelope(kind, *line_keys, _coupon().alias("coupon_id")), dt.alias("dt")
        )
        activities = joined.where(activity).select(
            *_envelope(
                kind, *line_keys, _text("l_suppkey").alias("activity_rule_id"),
                F.lit("a").alias("activity_id"),
            ),
            dt.alias("dt"),
        )
        return details, headers, coupons, activities

    def payment_feed(self, kind: str, first: str | None = None, last: str | None = None) -> DataFrame:
        """Payments of the orders that are not open, paid up to two days after the order."""
        rows = self.orders(first, last).where(F.col("o_orderstatus").isin("F", "P")).withColumn(
            "paid_at", _plus_seconds(F.col("o_orderdate"), F.col("o_orderkey") % 172800)
        )
        dt = F.lit(ORDER_DAY) if kind == "bootstrap-insert" else _day("paid_at")
        old = F.create_map(F.lit("payment_status"), F.lit("1601"))
        return rows.select(
            *_envelope(
                kind,
                _text("o_orderkey").alias("order_id"),
                F.substring("o_orderpriority", 1, 1).alias("payment_type"),
                money("o_totalprice").alias("total_amount"), F.lit("1602").alias("payment_status"),
                _time("paid_at").alias("callback_time"), old=old if kind == "update" else None,
            ),
            dt.alias("dt"),
        )

    def flow_open(self, day: str) -> DataFrame:
        """Orders placed before ``day`` and not finished by then, with their payment if made before ``day``."""
        rows = self.headers(last=shift(day, -1))
        paid_at = _plus_seconds(F.col("o_orderdate"), F.col("o_orderkey") % 172800)
        done = _plus_seconds(F.col("o_orderdate"), F.lit(FINISH_SECONDS))
        paid = F.col("o_orderstatus").isin("F", "P") & (_day(paid_at) < F.lit(day))
        none = F.lit(None).cast("string")
        return rows.where((F.col("o_orderstatus") != "F") | (_day(done) >= F.lit(day))).select(
            "order_id", "user_id", "province_id", F.col("day").alias("order_date_id"), "order_time",
            F.when(paid, _day(paid_at)).alias("payment_date_id"),
            F.when(paid, _time(paid_at)).alias("payment_time"), none.alias("finish_date_id"),
            none.alias("finish_time"), money("o_totalprice").alias("order_original_amount"),
            F.lit(None).cast(MONEY).alias("order_activity_amount"),
            money(F.lit(1)).alias("order_coupon_amount"), money("o_totalprice").alias("order_total_amount"),
            F.when(paid, money("o_totalprice")).alias("payment_amount"), F.lit("9999-12-31").alias("dt"),
        )

    def status_feed(self, kind: str = "insert", first: str | None = None, last: str | None = None) -> DataFrame:
        """Finished orders, five days after they were placed."""
        done = _plus_seconds(F.col("o_orderdate"), F.lit(FINISH_SECONDS))
        dt = F.lit(ORDER_DAY) if kind == "bootstrap-insert" else _day(done)
        return self.orders(first, last).where(F.col("o_orderstatus") == "F").select(
            *_envelope(
                kind, _text("o_orderkey").alias("order_id"), F.lit("1004").alias("order_status"),
                _time(done).alias("create_time"),
            ),
            dt.alias("dt"),
        )

    def dictionary(self) -> DataFrame:
        """Codes and names found in the order priorities, as pay types."""
        return self.table("orders").select(
            F.substring("o_orderpriority", 1, 1).alias("dic_code"),
            F.substring("o_orderpriority", 3, 100).alias("dic_name"), F.lit("11").alias("parent_code"),
        ).distinct().withColumn("dt", F.lit(ORDER_DAY))

    def payments(self) -> DataFrame:
        """Paid order lines in the shape of the payment fact, each with the whole order's total."""
        paid_at = _plus_seconds(F.col("o_orderdate"), F.col("o_orderkey") % 172800)
        paid = self.orders().where(F.col("o_orderstatus").isin("F", "P")).select(
            "o_orderkey", _text("o_custkey").alias("user_id"), _text("o_orderkey").alias("order_id"),
            money("o_totalprice").alias("split_payment_amount"), _day(paid_at).alias("dt"),
        )
        return self.table("lineitem").join(paid, F.col("l_orderkey") == F.col("o_orderkey")).select(
            "user_id", "order_id", F.col("l_quantity").cast("bigint").alias("sku_num"), "split_payment_amount", "dt"
        )

    def coupon_used(self, first: str | None = None, last: str | None = None) -> DataFrame:
        lines = self.lines(first, last).where((F.col("l_discount") > 0) & (F.col("l_discount") < 0.05))
        return lines.select(
            _line_id().alias("id"), _coupon().alias("coupon_id"), "user_id", "order_id",
            F.col("order_time").alias("used_time"), F.col("day").alias("dt"),
        )

    def coupon_use_feed(self, kind: str, first: str | None = None, last: str | None = None) -> DataFrame:
        """Coupon uses; returned lines only touch another field than ``used_time``."""
        rows = self.lines(first, last).where((F.col("l_discount") > 0) & (F.col("l_discount") < 0.05))
        used = F.col("l_returnflag") != "R"
        dt = F.lit(ORDER_DAY) if kind == "bootstrap-insert" else F.col("day")
        old = F.when(used, F.create_map(F.lit("used_time"), F.lit(""))).otherwise(
            F.create_map(F.lit("coupon_status"), F.lit("1401"))
        )
        return rows.select(
            *_envelope(
                kind, _line_id().alias("id"), _coupon().alias("coupon_id"), "user_id", "order_id",
                F.when(used, F.col("order_time")).alias("used_time"),
                old=old if kind == "update" else None,
            ),
            dt.alias("dt"),
        )

    def carts(self) -> DataFrame:
        """Cart snapshot: lines of open orders are not ordered yet, the others are."""
        return self.lines().select(
            _line_id().alias("id"), "user_id", _text("l_partkey").alias("sku_id"),
            F.concat(F.lit("sku "), "l_partkey").alias("sku_name"), F.col("l_quantity").cast("bigint").alias("sku_num"),
            F.when(F.col("o_orderstatus") == "O", "0").otherwise("1").alias("is_ordered"),
            F.lit(ORDER_DAY).alias("dt"),
        )

    # Dimensions

    def sku(self, day: str = ORDER_DAY) -> DataFrame:
        """Products in the shape of the product dimension."""
        size = _text("p_size")
        middle = F.floor(F.col("p_size") / 10).cast("string")
        return self.table("part").select(
            _text("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
            F.col("p_type").alias("category1_id"), F.concat(F.lit("c1 "), "p_type").alias("category1_name"),
            F.concat("p_type", F.lit("-"), middle).alias("category2_id"),
            F.concat(F.lit("c2 "), "p_type", F.lit("-"), middle).alias("category2_name"),
            F.concat("p_type", F.lit("-"), size).alias("category3_id"),
            F.concat(F.lit("c3 "), "p_type", F.lit("-"), size).alias("category3_name"),
            F.col("p_brand").alias("tm_id"), F.concat(F.lit("tm "), "p_brand").alias("tm_name"),
            F.lit(day).alias("dt"),
        )

    def province(self, day: str = ORDER_DAY) -> DataFrame:
        return self.table("nation").select(
            _text("n_nationkey").alias("id"), F.col("n_name").alias("province_name"),
            _text("n_nationkey").alias("area_code"), F.concat(F.lit("N"), "n_nationkey").alias("iso_code"),
            F.concat(F.lit("X-"), "n_nationkey").alias("iso_3166_2"), F.lit(day).alias("dt"),
        )

    def coupon(self, day: str = ORDER_DAY) -> DataFrame:
        """Coupons, one per part, in the shape of the coupon dimension."""
        return self.table("part").select(
            _text("p_partkey").alias("id"), F.col("p_name").alias("coupon_name"),
            _text("p_size").alias("coupon_type_code"), F.col("p_type").alias("coupon_type_name"),
            F.col("p_brand").alias("benefit_rule"), F.lit(day).alias("dt"),
        )

    # Full table copies

    def dictionary_of_regions(self, day: str = ORDER_DAY) -> DataFrame:
        """Each region as one code under every parent: activity types, coupon types, coupon ranges."""
        parents = F.explode(F.array(F.lit("31"), F.lit("32"), F.lit("33")))
        return self.table("region").select(
            "r_regionkey", "r_name", parents.alias("parent_code")
        ).select(
            F.concat("parent_code", F.lit("0"), "r_regionkey").alias("dic_code"),
            F.concat("r_name", F.lit(" "), "parent_code").alias("dic_name"), "parent_code", F.lit(day).alias("dt"),
        )

    def coupon_info(self, day: str = ORDER_DAY) -> DataFrame:
        """Parts as coupons; the tens of the size choose the type, the brand's length the range."""
        price, none = money("p_retailprice"), F.lit(None).cast("string")
        return self.table("part").select(
            _text("p_partkey").alias("id"), F.col("p_name").alias("coupon_name"),
            F.concat(F.lit("320"), _text(F.floor(F.col("p_size") / 10))).alias("coupon_type"),
            price.alias("condition_amount"), F.col("p_size").cast("bigint").alias("condition_num"),
            none.alias("activity_id"), price.alias("benefit_amount"), money("p_size").alias("benefit_discount"),
            none.alias("create_time"), F.concat(F.lit("330"), _text(F.length("p_brand") - 5)).alias("range_type"),
            F.col("p_size").cast("bigint").alias("limit_num"), F.lit(0).cast("bigint").alias("taken_count"),
            none.alias("start_time"), none.alias("end_time"), none.alias("operate_time"),
            none.alias("expire_time"), none.alias("range_desc"), F.lit(day).alias("dt"),
        )

    def activity_rule(self, day: str = ORDER_DAY) -> DataFrame:
        """Suppliers as activity rules of their nation's activity."""
        amount = money("s_acctbal")
        return self.table("supplier").select(
            _text("s_suppkey").alias("id"), _text("s_nationkey").alias("activity_id"),
            F.concat(F.lit("310"), _text(F.floor(F.col("s_nationkey") / 5))).alias("activity_type"),
            amount.alias("condition_amount"), F.col("s_nationkey").cast("bigint").alias("condition_num"),
            amount.alias("benefit_amount"), money("s_nationkey").alias("benefit_discount"),
            F.lit("1").alias("benefit_level"), F.lit(None).cast("string").alias("create_time"),
            F.lit(day).alias("dt"),
        )

    def activity_info(self, day: str = ORDER_DAY) -> DataFrame:
        none = F.lit(None).cast("string")
        return self.table("nation").select(
            _text("n_nationkey").alias("id"), F.col("n_name").alias("activity_name"),
            F.concat(F.lit("about "), "n_name").alias("activity_desc"), none.alias("start_time"),
            none.alias("end_time"), F.lit(day).alias("dt"),
        )

    def sku_sources(self, day: str = ORDER_DAY) -> dict[str, DataFrame]:
        """The eight inputs of the product dimension."""
        part, dt = self.table("part"), F.lit(day).alias("dt")
        c3 = F.concat("p_type", F.lit("-"), _text("p_size"))
        c2 = F.concat("p_type", F.lit("-"), _text(F.floor(F.col("p_size") / 10)))
        return {
            "sku": part.select(
                _text("p_partkey").alias("id"), _text("p_size").alias("spu_id"), money("p_retailprice").alias("price"),
                F.col("p_name").alias("sku_name"), F.col("p_type").alias("sku_desc"), money("p_size").alias("weight"),
                F.col("p_brand").alias("tm_id"), c3.alias("category3_id"),
                F.when(F.col("p_size") < 25, "1").otherwise("0").alias("is_sale"),
                F.lit("2024-01-01 00:00:00").alias("create_time"), dt,
            ),
            "spu": part.select(
                _text("p_size").alias("id"), F.concat(F.lit("spu "), "p_size").alias("spu_name"), dt
            ).distinct(),
            "category3": part.select(
                c3.alias("id"), F.concat(F.lit("c3 "), c3).alias("name"), c2.alias("category2_id"), dt
            ).distinct(),
            "category2": part.select(
                c2.alias("id"), F.concat(F.lit("c2 "), c2).alias("name"), F.col("p_type").alias("category1_id"), dt
            ).distinct(),
            "category1": part.select(
                F.col("p_type").alias("id"), F.concat(F.lit("c1 "), "p_type").alias("name"), dt
            ).distinct(),
            "trademark": part.select(
                F.col("p_brand").alias("id"), F.concat(F.lit("tm "), "p_brand").alias("tm_name"), dt
            ).distinct(),
            "attrs": part.select(
                _text("p_partkey").alias("sku_id"),
                F.explode(F.array(
                    F.struct(F.lit("1").alias("attr_id"), F.lit("size").alias("attr_name"),
                             _text("p_size").alias("value_id")),
                    F.struct(F.lit("2").alias("attr_id"), F.lit("brand").alias("attr_name"),
                             F.col("p_brand").alias("value_id")),
                )).alias("a"),
                dt,
            ).select("sku_id", "a.*", F.col("a.value_id").alias("value_name"), "dt"),
            "sale_attrs": self.table("lineitem").select(
                _text("l_partkey").alias("sku_id"), F.lit("1").alias("sale_attr_id"),
                F.col("l_returnflag").alias("sale_attr_value_id"), F.lit("flag").alias("sale_attr_name"),
                F.col("l_linestatus").alias("sale_attr_value_name"), dt,
            ).distinct(),
        }

    def promotion_pos(self, day: str = ORDER_DAY) -> DataFrame:
        none = F.lit(None).cast("string")
        return self.table("supplier").select(
            _text("s_suppkey").alias("id"), F.col("s_name").alias("pos_location"),
            _text("s_nationkey").alias("pos_type"), none.alias("promotion_type"), none.alias("create_time"),
            none.alias("operate_time"), F.lit(day).alias("dt"),
        )

    def promotion_refer(self, day: str = ORDER_DAY) -> DataFrame:
        none = F.lit(None).cast("string")
        return self.table("supplier").select(
            _text("s_suppkey").alias("id"), F.col("s_name").alias("refer_name"), none.alias("create_time"),
            none.alias("operate_time"), F.lit(day).alias("dt"),
        )

    def base_province(self, day: str = ORDER_DAY) -> DataFrame:
        return self.table("nation").select(
            _text("n_nationkey").alias("id"), F.col("n_name").alias("name"),
            _text("n_regionkey").alias("region_id"), _text("n_nationkey").alias("area_code"),
            F.concat(F.lit("N"), "n_nationkey").alias("iso_code"),
            F.concat(F.lit("X-"), "n_nationkey").alias("iso_3166_2"), F.lit(day).alias("dt"),
        )

    def base_region(self, day: str = ORDER_DAY) -> DataFrame:
        return self.table("region").select(
            _text("r_regionkey").alias("id"), F.col("r_name").alias("region_name"), F.lit(day).alias("dt")
        )

    def priority_codes(self) -> DataFrame:
        """Orders with their priority as a bare code."""
        return self.table("orders").select(
            _text("o_orderkey").alias("order_id"), F.substring("o_orderpriority", 1, 1).alias("payment_type_code")
        )

    # Log and interaction

    def events(self, day: str | None = None) -> DataFrame:
        """Events of one UTC day or of all; the day is a range on the stored time and reaches the scan."""
        rows = self.table("events")
        if day is not None:
            rows = rows.where(
                (F.col("ts") >= F.lit(day).cast("timestamp_ntz"))
                & (F.col("ts") < F.lit(shift(day, 1)).cast("timestamp_ntz"))
            )
        return rows.withColumns({
            "k": F.get_json_object("props", "$.k").cast("bigint"),
            "day": _day("ts"),
            "ms": F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")),
        })

    def log(self, day: str | None = None) -> DataFrame:
        """Every event as a nested log event of its UTC day."""
        e = self.events(day)
        user, k, kind = _text("user_id"), F.col("k"), F.col("event_type")
        common = F.struct(
            _text(k % 34).alias("ar"), F.concat(F.lit("brand"), _text(F.col("user_id") % 3)).alias("ba"),
            F.concat(F.lit("ch"), _text(F.col("user_id") % 5)).alias("ch"), F.lit("0").alias("is_new"),
            F.concat(F.lit("model"), _text(F.col("user_id") % 4)).alias("md"), user.alias("mid"),
            F.lit("os").alias("os"), F.concat(user, F.lit("-"), "day").alias("sid"),
            F.when(k >= 5, user).alias("uid"), F.lit("v1").alias("vc"),
        )
        page = F.struct(
            _text(F.round(F.col("value") * 1000).cast("bigint")).alias("during_time"), _text(k).alias("item"),
            F.lit("sku_id").alias("item_type"), F.lit(None).cast("string").alias("last_page_id"),
            _page(kind).alias("page_id"), F.lit(None).cast("string").alias("from_pos_id"),
            F.lit(None).cast("string").alias("from_pos_seq"), F.lit(None).cast("string").alias("refer_id"),
            F.lit(None).cast("string").alias("sourceType"),
        )
        numbers = F.sequence(F.lit(1), (k % 3).cast("int"))
        some = F.when(k % 3 > 0, numbers).otherwise(F.array().cast("array<int>"))
        actions = F.transform(some, lambda i: F.struct(
            F.concat(F.lit("act"), i.cast("string")).alias("action_id"), _text(k).alias("item"),
            F.lit("sku_id").alias("item_type"), (F.col("ms") + i).alias("ts"),
        ))
        displays = F.transform(some, lambda i: F.struct(
            F.lit("query").alias("display_type"), _text(k + i).alias("item"), F.lit("sku_id").alias("item_type"),
            i.cast("string").alias("pos_seq"), F.lit("p1").alias("pos_id"),
        ))
        start = F.when(kind == "signup", F.struct(
            F.lit("icon").alias("entry"), F.lit(0).cast("bigint").alias("first_open"), k.alias("loading_time"),
            k.alias("open_ad_id"), k.alias("open_ad_ms"), F.lit(0).cast("bigint").alias("open_ad_skip_ms"),
        ))
        err = F.when(kind == "error", F.struct(k.alias("error_code"), F.concat(F.lit("m"), _text(k)).alias("msg")))
        return e.select(
            common.alias("common"), F.when(kind != "purchase", page).alias("page"), actions.alias("actions"),
            displays.alias("displays"), start.alias("start"), err.alias("err"), F.col("ms").alias("ts"),
            F.col("day").alias("dt"),
        )

    def page_views(self, day: str | None = None) -> DataFrame:
        """Every event as a flat page view."""
        e = self.events(day)
        user = _text("user_id")
        return e.select(
            user.alias("mid_id"), F.concat(F.lit("brand"), _text(F.col("user_id") % 3)).alias("brand"),
            F.concat(F.lit("model"), _text(F.col("user_id") % 4)).alias("model"),
            F.lit("os").alias("operate_system"), F.lit("v1").alias("version_code"),
            F.concat(F.lit("ch"), _text(F.col("user_id") % 5)).alias("channel"), user.alias("user_id"),
            F.concat(user, F.lit("-"), "day").alias("session_id"), _page(F.col("event_type")).alias("page_id"),
            _time("ts").alias("view_time"), F.col("ms").alias("ts"),
            F.round(F.col("value") * 1000).cast("bigint").alias("during_time"), F.col("day").alias("dt"),
        )

    def logins(self) -> DataFrame:
        """Purchases as logins, and those of earlier days as registrations.

        A user stands for eight by the purchased item: so there are new users in the last days too.
        """
        rows = self.events().where(F.col("event_type") == "purchase")
        user = F.concat_ws("-", _text("user_id"), _text(F.col("k") % 8))
        return rows.select(user.alias("user_id"), F.col("day").alias("dt"))

    def event_orders(self, day: str | None = None) -> DataFrame:
        """Purchases as one-line orders in the shape of the order detail fact."""
        none = F.lit(0).cast(MONEY)
        return self.events(day).where(F.col("event_type") == "purchase").select(
            _text("event_id").alias("order_id"), _text("user_id").alias("user_id"), _text("k").alias("sku_id"),
            F.col("k").alias("sku_num"), money("value").alias("split_original_amount"),
            none.alias("split_activity_amount"), none.alias("split_coupon_amount"),
            money("value").alias("split_total_amount"), money("value").alias("split_payment_amount"),
            F.col("day").alias("dt"),
        )

    def cart_feed(self, day: str | None = None) -> DataFrame:
        """Clicks insert, views update; the old quantity is the event's value, missing when that is below one."""
        e = self.events(day).where(F.col("event_type").isin("click", "view"))
        kind = F.when(F.col("event_type") == "click", "insert").otherwise("update")
        before = F.floor("value")
        old = F.when(
            kind == "update",
            F.when(before < 1, F.create_map(F.lit("is_checked"), F.lit("1"))).otherwise(
                F.create_map(F.lit("sku_num"), before.cast("string"))
            ),
        )
        return e.select(
            kind.alias("type"), F.col("ms").alias("ts"),
            F.struct(
                _text("event_id").alias("id"), _text("user_id").alias("user_id"), _text("k").alias("sku_id"),
                F.col("k").alias("sku_num"), _time("ts").alias("create_time"), _time("ts").alias("operate_time"),
            ).alias("data"),
            old.alias("old"), F.col("day").alias("dt"),
        )

    def cart_adds(self, day: str | None = None) -> DataFrame:
        """Clicks as cart additions."""
        return self.events(day).where(F.col("event_type") == "click").select(
            _text("user_id").alias("user_id"), F.col("k").alias("sku_num"), F.col("day").alias("dt")
        )

    def favor_feed(self, day: str | None = None) -> DataFrame:
        e = self.events(day).where(F.col("event_type").isin("click", "error"))
        kind = F.when(F.col("event_type") == "click", "insert").otherwise("update")
        return e.select(
            kind.alias("type"), F.col("ms").alias("ts"),
            F.struct(
                _text("event_id").alias("id"), _text("user_id").alias("user_id"), _text("k").alias("sku_id"),
                _time("ts").alias("create_time"),
            ).alias("data"),
            F.lit(None).cast("map<string,string>").alias("old"), F.col("day").alias("dt"),
        )

    def favors(self, day: str | None = None) -> DataFrame:
        return self.events(day).where(F.col("event_type") == "click").select(
            _text("event_id").alias("id"), _text("user_id").alias("user_id"), _text("k").alias("sku_id"),
            F.col("day").alias("dt"),
        )

    # Users

    def user_boot(self) -> DataFrame:
        """All customers as the bootstrap copy of the event day, among changes of other kinds and days."""
        copy = self.table("customer").select(
            F.lit("bootstrap-insert").alias("type"), F.lit(0).cast("bigint").alias("ts"),
            F.struct(
                _text("c_custkey").alias("id"), F.col("c_name").alias("name"),
                F.col("c_mktsegment").alias("user_level"),
            ).alias("data"),
            F.lit(EVENT_DAY).alias("dt"),
        )
        return copy.unionByName(self.user_feed())

    def user_open(self) -> DataFrame:
        """Customers as open interval rows from before the first event day."""
        return self.table("customer").select(
            _text("c_custkey").alias("id"), F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("user_level"), F.lit("2023-12-31").alias("start_date"),
            F.lit("9999-12-31").alias("end_date"), F.lit("9999-12-31").alias("dt"),
        )

    def user_feed(self, day: str | None = None) -> DataFrame:
        """Sign-ups as changes of a user's level, several per user and day."""
        e = self.events(day).where(F.col("event_type") == "signup")
        return e.select(
            F.lit("update").alias("type"), F.col("ms").alias("ts"),
            F.struct(
                _text("user_id").alias("id"), F.concat(F.lit("user "), _text("user_id")).alias("name"),
                F.concat(F.lit("L"), _text("k")).alias("user_level"),
            ).alias("data"),
            F.col("day").alias("dt"),
        )

    def user_transactions(self) -> DataFrame:
        """Three changes of every customer in one second of the event day: two in a later transaction, whose last one has the smallest values."""
        steps = F.explode(F.array(*[
            F.struct(F.lit(name).alias("name"), F.lit(xid).cast("bigint").alias("xid"), F.lit(place).cast("bigint").alias("xoffset"), F.lit(last).alias("commit"))
            for name, xid, place, last in (("z first", 5, None, True), ("y second", 7, 3, False), ("a third", 7, None, True))
        ]))
        return self.table("customer").withColumn("s", steps).select(
            F.lit("update").alias("type"), F.lit(1704067200).cast("bigint").alias("ts"),
            F.struct(
                _text("c_custkey").alias("id"), F.concat("s.name", F.lit(" "), _text("c_custkey")).alias("name"),
                F.substring("s.name", 1, 1).alias("user_level"),
            ).alias("data"),
            "s.xid", "s.xoffset", "s.commit", F.lit(EVENT_DAY).alias("dt"),
        )

    def register_feed(self) -> DataFrame:
        """Customers as users registered on the event day."""
        return self.table("customer").select(
            *_envelope(
                "insert", _text("c_custkey").alias("id"), F.lit(f"{EVENT_DAY} 08:00:00").alias("create_time")
            ),
            F.lit(EVENT_DAY).alias("dt"),
        )


def _envelope(kind: str, *data: Column | str, old: Column | None = None) -> list[Column]:
    return [
        F.lit(kind).alias("type"), F.lit(0).cast("bigint").alias("ts"), F.struct(*data).alias("data"),
        (old if old is not None else F.lit(None).cast("map<string,string>")).alias("old"),
    ]


def _text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _time(column: Column | str) -> Column:
    return F.substring(_text(column), 1, 19)


def _day(column: Column | str) -> Column:
    return _text((F.col(column) if isinstance(column, str) else column).cast("date"))


def _plus_seconds(column: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, column)


def _line_id() -> Column:
    """Text that tells lines apart: their key repeats, the measures with it do not."""
    return F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint"),
        money("l_extendedprice"),
    )


def _coupon() -> Column:
    return F.round(F.col("l_discount") * 100).cast("int").cast("string")


def _page(kind: Column) -> Column:
    return F.when(kind == "view", "home").when(kind == "click", "good_detail").when(
        kind == "signup", "register"
    ).otherwise(kind)
