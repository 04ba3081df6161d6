"""Declared schemas. Files are never inferred: absent fields read as NULL, unknown fields are ignored."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "s": T.StringType(),
    "n": T.LongType(),
    "d": T.DecimalType(16, 2),
}


def row(fields: str) -> T.StructType:
    """``"id price:d num:n"`` to a struct; a field without a kind is a string."""
    struct = T.StructType()
    for field in fields.split():
        name, _, kind = field.partition(":")
        struct = struct.add(name, _KINDS[kind or "s"])
    return struct


def envelope(data: T.StructType, position: bool = False) -> T.StructType:
    """A change; ``position`` adds its place in the database's log: transaction, place in it, and whether it ends it."""
    change = (
        T.StructType()
        .add("type", T.StringType())
        .add("ts", T.LongType())
        .add("data", data)
        .add("old", T.MapType(T.StringType(), T.StringType()))
    )
    if position:
        change = change.add("xid", T.LongType()).add("xoffset", T.LongType()).add("commit", T.BooleanType())
    return change


# The field names of the click log, the database change feeds and the full table copies.
LOG = (
    T.StructType()
    .add("common", row("ar ba ch is_new md mid os sid uid vc"))
    .add(
        "page",
        row("during_time item item_type last_page_id page_id from_pos_id from_pos_seq refer_id sourceType"),
    )
    .add("actions", T.ArrayType(row("action_id item item_type ts:n")))
    .add("displays", T.ArrayType(row("display_type item item_type pos_seq pos_id")))
    .add("start", row("entry first_open:n loading_time:n open_ad_id:n open_ad_ms:n open_ad_skip_ms:n"))
    .add("err", row("error_code:n msg"))
    .add("ts", T.LongType())
)

FEED_DATA = {
    "cart_info": row(
        "id user_id sku_id cart_price:d sku_num:n img_url sku_name is_checked create_time operate_time is_ordered"
        " order_time"
    ),
    "comment_info": row(
        "id user_id nick_name head_img sku_id spu_id order_id appraise comment_txt create_time operate_time"
    ),
    "coupon_use": row(
        "id coupon_id user_id order_id coupon_status get_time using_time used_time expire_time create_time"
        " operate_time"
    ),
    "favor_info": row("id user_id sku_id spu_id is_cancel create_time operate_time"),
    "order_detail": row(
        "id order_id sku_id sku_name img_url order_price:d sku_num:n create_time source_type source_id"
        " split_total_amount:d split_activity_amount:d split_coupon_amount:d operate_time"
    ),
    "order_detail_activity": row(
        "id order_id order_detail_id activity_id activity_rule_id sku_id create_time operate_time"
    ),
    "order_detail_coupon": row(
        "id order_id order_detail_id coupon_id coupon_use_id sku_id create_time operate_time"
    ),
    "order_info": row(
        "id consignee consignee_tel total_amount:d order_status user_id payment_way delivery_address order_comment"
        " out_trade_no trade_body create_time operate_time expire_time process_status tracking_no parent_order_id"
        " img_url province_id activity_reduce_amount:d coupon_reduce_amount:d original_total_amount:d freight_fee:d"
        " freight_fee_reduce:d refundable_time:d"
    ),
    "order_refund_info": row(
        "id user_id order_id sku_id refund_type refund_num:n refund_amount:d refund_reason_type refund_reason_txt"
        " refund_status create_time operate_time"
    ),
    "order_status_log": row("id order_id order_status create_time operate_time"),
    "payment_info": row(
        "id out_trade_no order_id user_id payment_type trade_no total_amount:d subject payment_status create_time"
        " callback_time callback_content operate_time"
    ),
    "refund_payment": row(
        "id out_trade_no order_id sku_id payment_type trade_no total_amount:d subject refund_status create_time"
        " callback_time callback_content operate_time"
    ),
    "user_info": row(
        "id login_name nick_name passwd name phone_num email head_img user_level birthday gender create_time"
        " operate_time status"
    ),
}

SNAPSHOTS = {
    "activity_info": row(
        "id activity_name activity_type activity_desc start_time end_time create_time operate_time"
    ),
    "activity_rule": row(
        "id activity_id activity_type condition_amount:d condition_num:n benefit_amount:d benefit_discount:d"
        " benefit_level create_time operate_time"
    ),
    "base_category1": row("id name create_time operate_time"),
    "base_category2": row("id name category1_id create_time operate_time"),
    "base_category3": row("id name category2_id create_time operate_time"),
    "base_dic": row("dic_code dic_name parent_code create_time operate_time"),
    "base_province": row("id name region_id area_code iso_code iso_3166_2 create_time operate_time"),
    "base_region": row("id region_name create_time operate_time"),
    "base_trademark": row("id tm_name logo_url create_time operate_time"),
    "cart_info": row(
        "id user_id sku_id cart_price:d sku_num:n img_url sku_name is_checked create_time operate_time is_ordered"
        " order_time"
    ),
    "coupon_info": row(
        "id coupon_name coupon_type condition_amount:d condition_num:n activity_id benefit_amount:d"
        " benefit_discount:d create_time range_type limit_num:n taken_count:n start_time end_time operate_time"
        " expire_time range_desc"
    ),
    "sku_attr_value": row("id attr_id value_id sku_id attr_name value_name create_time operate_time"),
    "sku_info": row(
        "id spu_id price:d sku_name sku_desc weight:d tm_id category3_id sku_default_img is_sale create_time"
        " operate_time"
    ),
    "sku_sale_attr_value": row(
        "id sku_id spu_id sale_attr_value_id sale_attr_id sale_attr_name sale_attr_value_name create_time"
        " operate_time"
    ),
    "spu_info": row("id spu_name description category3_id tm_id create_time operate_time"),
    "promotion_pos": row("id pos_location pos_type promotion_type create_time operate_time"),
    "promotion_refer": row("id refer_name create_time operate_time"),
}

CALENDAR = row("date_id week_id week_day day month quarter year is_workday holiday_id")

# Primary keys of the exported report tables. The two top-three reports also carry the product,
# because equal ranks are kept.
REPORT_KEYS = {
    "ads_traffic_stats_by_channel": ["dt", "recent_days", "channel"],
    "ads_page_path": ["dt", "source", "target"],
    "ads_user_change": ["dt"],
    "ads_user_retention": ["dt", "create_date", "retention_day"],
    "ads_user_stats": ["dt", "recent_days"],
    "ads_user_action": ["dt"],
    "ads_new_order_user_stats": ["dt", "recent_days"],
    "ads_order_continuously_user_count": ["dt", "recent_days"],
    "ads_repeat_purchase_by_tm": ["dt", "recent_days", "tm_id"],
    "ads_order_stats_by_tm": ["dt", "recent_days", "tm_id"],
    "ads_order_stats_by_cate": ["dt", "recent_days", "category3_id"],
    "ads_order_by_province": ["dt", "recent_days", "province_id"],
    "ads_coupon_stats": ["dt", "coupon_id"],
    "ads_sku_cart_num_top3_by_cate": ["dt", "category3_id", "sku_id"],
    "ads_sku_favor_count_top3_by_tm": ["dt", "tm_id", "sku_id"],
    "ads_order_to_pay_interval_avg": ["dt"],
}
