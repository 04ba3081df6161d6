"""Dimension tables from full table copies.

No join is forced to broadcast: dimension inputs are scans with known file sizes, so small ones broadcast by
Spark's own size check and large ones fall back to a shuffled join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.functions.columns import on_day

# Parent codes of the dictionary.
PAY_TYPE, ACTIVITY_TYPE, COUPON_TYPE, RANGE_TYPE = "11", "31", "32", "33"


def decode_dictionary(df: DataFrame, dic: DataFrame, code: str, parent: str, name: str) -> DataFrame:
    """Add ``name``, the dictionary text of ``code`` among the entries of one parent."""
    entries = dic.where(F.col("parent_code") == F.lit(parent)).select(
        F.col("dic_code").alias("_code"), F.col("dic_name").alias(name)
    )
    return df.join(entries, F.col(code) == F.col("_code"), "left").drop("_code")


def dim_sku(
    sku: DataFrame,
    spu: DataFrame,
    category3: DataFrame,
    category2: DataFrame,
    category1: DataFrame,
    trademark: DataFrame,
    attrs: DataFrame,
    sale_attrs: DataFrame,
    day: str,
) -> DataFrame:
    """Product with its model, category tree, brand and both attribute lists."""
    sku = on_day(sku, day).select(
        "id", "price", "sku_name", "sku_desc", "weight", F.col("is_sale").try_cast("boolean").alias("is_sale"),
        "spu_id", "category3_id", "tm_id", "create_time",
    )
    c3 = on_day(category3, day).select(
        F.col("id").alias("category3_id"), F.col("name").alias("category3_name"), "category2_id"
    )
    c2 = on_day(category2, day).select(
        F.col("id").alias("category2_id"), F.col("name").alias("category2_name"), "category1_id"
    )
    c1 = on_day(category1, day).select(F.col("id").alias("category1_id"), F.col("name").alias("category1_name"))
    brand = on_day(trademark, day).select(F.col("id").alias("tm_id"), "tm_name")
    model = on_day(spu, day).select(F.col("id").alias("spu_id"), "spu_name")
    plain = _attribute_list(
        on_day(attrs, day), "sku_attr_values", ["attr_id", "value_id", "attr_name", "value_name"]
    )
    sale = _attribute_list(
        on_day(sale_attrs, day),
        "sku_sale_attr_values",
        ["sale_attr_id", "sale_attr_value_id", "sale_attr_name", "sale_attr_value_name"],
    )
    # The small sides first; the two attribute lists share the product key, so they cost one exchange each and
    # the product side is shuffled once.
    wide = sku.join(model, "spu_id", "left").join(c3, "category3_id", "left").join(c2, "category2_id", "left")
    wide = wide.join(c1, "category1_id", "left").join(brand, "tm_id", "left")
    wide = wide.join(plain, wide["id"] == plain["sku_id"], "left").drop("sku_id")
    wide = wide.join(sale, wide["id"] == sale["sku_id"], "left").drop("sku_id")
    return wide.select(
        "id", "price", "sku_name", "sku_desc", "weight", "is_sale", "spu_id", "spu_name", "category3_id",
        "category3_name", "category2_id", "category2_name", "category1_id", "category1_name", "tm_id", "tm_name",
        "sku_attr_values", "sku_sale_attr_values", "create_time", F.lit(day).alias("dt"),
    )


def _attribute_list(attrs: DataFrame, name: str, fields: list[str]) -> DataFrame:
    return attrs.groupBy("sku_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def dim_coupon(coupon: DataFrame, dic: DataFrame, day: str) -> DataFrame:
    rows = on_day(coupon, day).withColumnsRenamed(
        {"coupon_type": "coupon_type_code", "range_type": "range_type_code"}
    )
    dic = on_day(dic, day)
    rows = decode_dictionary(rows, dic, "coupon_type_code", COUPON_TYPE, "coupon_type_name")
    rows = decode_dictionary(rows, dic, "range_type_code", RANGE_TYPE, "range_type_name")
    rule = _rule_text("coupon_type_code", full_cut="3201", piece_discount="3202", plain="3203", plain_cut=True)
    return rows.select(
        "id", "coupon_name", "coupon_type_code", "coupon_type_name", "condition_amount", "condition_num",
        "activity_id", "benefit_amount", "benefit_discount", rule.alias("benefit_rule"), "create_time",
        "range_type_code", "range_type_name", "limit_num", "taken_count", "start_time", "end_time", "operate_time",
        "expire_time", F.lit(day).alias("dt"),
    )


def dim_activity(rule: DataFrame, info: DataFrame, dic: DataFrame, day: str) -> DataFrame:
    rules = on_day(rule, day).select(
        F.col("id").alias("activity_rule_id"), "activity_id", F.col("activity_type").alias("activity_type_code"),
        "create_time", "condition_amount", "condition_num", "benefit_amount", "benefit_discount", "benefit_level",
    )
    about = on_day(info, day).select(
        F.col("id").alias("activity_id"), "activity_name", "activity_desc", "start_time", "end_time"
    )
    rows = rules.join(about, "activity_id", "left")
    rows = decode_dictionary(rows, on_day(dic, day), "activity_type_code", ACTIVITY_TYPE, "activity_type_name")
    text = _rule_text("activity_type_code", full_cut="3101", piece_discount="3102", plain="3103", plain_cut=False)
    return rows.select(
        "activity_rule_id", "activity_id", "activity_name", "activity_type_code", "activity_type_name",
        "activity_desc", "start_time", "end_time", "create_time", "condition_amount", "condition_num",
        "benefit_amount", "benefit_discount", text.alias("benefit_rule"), "benefit_level", F.lit(day).alias("dt"),
    )


def _rule_text(code: str, full_cut: str, piece_discount: str, plain: str, plain_cut: bool) -> Column:
    """Rule wording by type code; other codes and missing amounts give NULL."""
    # The wording of the rule texts.
    cut = F.concat(F.lit("满"), "condition_amount", F.lit("元减"), "benefit_amount", F.lit("元"))
    pieces = F.concat(F.lit("满"), "condition_num", F.lit("件打"), "benefit_discount", F.lit("折"))
    if plain_cut:
        unconditional = F.concat(F.lit("无门槛减"), "benefit_amount", F.lit("元"))
    else:
        unconditional = F.concat(F.lit("无门槛打"), "benefit_discount", F.lit("折"))
    kind = F.col(code)
    return F.when(kind == full_cut, cut).when(kind == piece_discount, pieces).when(kind == plain, unconditional)


def dim_province(province: DataFrame, region: DataFrame, day: str) -> DataFrame:
    regions = on_day(region, day).select(F.col("id").alias("region_id"), "region_name")
    rows = on_day(province, day).withColumnRenamed("name", "province_name").join(regions, "region_id", "left")
    return rows.select(
        "id", "province_name", "area_code", "iso_code", "iso_3166_2", "region_id", "region_name",
        F.lit(day).alias("dt"),
    )


def dim_promotion_pos(pos: DataFrame, day: str) -> DataFrame:
    return on_day(pos, day).select(
        "id", "pos_location", "pos_type", "promotion_type", "create_time", "operate_time", "dt"
    )


def dim_promotion_refer(refer: DataFrame, day: str) -> DataFrame:
    return on_day(refer, day).select("id", "refer_name", "create_time", "operate_time", "dt")


def dim_date(calendar: DataFrame) -> DataFrame:
    return calendar.select(
        "date_id", "week_id", "week_day", "day", "month", "quarter", "year", "is_workday", "holiday_id"
    )


def calendar_days(bounds: DataFrame) -> DataFrame:
    """Calendar rows for every day between ``first_day`` and ``last_day`` of a one-row frame.

    Working days are Monday to Friday and holidays are unknown; load a published calendar where those matter.
    """
    days = bounds.select(
        F.explode(F.sequence(F.col("first_day").cast("date"), F.col("last_day").cast("date"))).alias("d")
    )
    weekday = F.weekday("d") + F.lit(1)
    return days.select(
        F.col("d").cast("string").alias("date_id"),
        F.weekofyear("d").cast("string").alias("week_id"),
        weekday.cast("string").alias("week_day"),
        F.dayofmonth("d").cast("string").alias("day"),
        F.month("d").cast("string").alias("month"),
        F.quarter("d").cast("string").alias("quarter"),
        F.year("d").cast("string").alias("year"),
        F.when(weekday <= 5, "1").otherwise("0").alias("is_workday"),
        F.lit(None).cast("string").alias("holiday_id"),
    )
