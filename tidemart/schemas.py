"""Schemas of the messages and tables. Values stay text from source to sink."""

from __future__ import annotations

from pyspark.sql import types as T


def text_columns(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


TEXT_MAP = T.MapType(T.StringType(), T.StringType())

# Change-log envelope: one row-level change of the shop's database.
CHANGE = T.StructType([
    T.StructField("database", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("ts", T.StringType()),
    T.StructField("xoffset", T.LongType()),
    T.StructField("data", TEXT_MAP),
    T.StructField("old", TEXT_MAP),
])

# The same with the payload's JSON types kept.
CHANGE_TYPED = T.StructType([
    T.StructField("data", T.MapType(T.StringType(), T.VariantType())) if f.name == "data" else f for f in CHANGE])

# Page log. Maps keep fields that are not known in advance, and values keep their JSON types.
VALUE_MAP = T.MapType(T.StringType(), T.VariantType())
PAGE_LOG = T.StructType([
    T.StructField("common", VALUE_MAP),
    T.StructField("page", VALUE_MAP),
    T.StructField("start", VALUE_MAP),
    T.StructField("displays", T.ArrayType(VALUE_MAP)),
    T.StructField("actions", T.ArrayType(VALUE_MAP)),
    T.StructField("err", VALUE_MAP),
    T.StructField("ts", T.StringType()),
])

# Page record as the keyword job reads it back.
PAGE_VIEW = T.StructType([
    T.StructField("common", TEXT_MAP),
    T.StructField("page", TEXT_MAP),
    T.StructField("ts", T.LongType()),
])

# One row of the routing configuration.
ROUTE = text_columns(
    "source_table source_type sink_table sink_type sink_columns sink_pk sink_extend")


def table_change(row: T.StructType) -> T.StructType:
    """Change record of one watched table: images before and after, and the operation."""
    return T.StructType([
        T.StructField("before", row),
        T.StructField("after", row),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ])


DICTIONARY = text_columns("dic_code dic_name")

PERSON = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
])

KEYWORD_WINDOW = T.StructType([
    T.StructField("stt", T.StringType()),
    T.StructField("edt", T.StringType()),
    T.StructField("keyword", T.StringType()),
    T.StructField("keyword_count", T.LongType()),
    T.StructField("ts", T.LongType()),
])

EMPLOYEE = T.StructType([
    T.StructField("empno", T.IntegerType()),
    T.StructField("ename", T.StringType()),
    T.StructField("deptno", T.IntegerType()),
    T.StructField("ts", T.LongType()),
])

DEPARTMENT = T.StructType([
    T.StructField("deptno", T.IntegerType()),
    T.StructField("dname", T.StringType()),
    T.StructField("ts", T.LongType()),
])

# Order-line fact as the payment job reads it back.
ORDER_LINE_FACT = text_columns(
    "id order_id user_id sku_id sku_name province_id activity_id activity_rule_id coupon_id "
    "date_id create_time source_id source_type source_type_name sku_num split_original_amount "
    "split_activity_amount split_coupon_amount split_total_amount ts")
