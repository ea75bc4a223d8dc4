"""Explicit schemas of every source: sample tables, messages and landing files."""

from pyspark.sql.types import (
    ArrayType, DecimalType, DoubleType, FloatType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampNTZType, TimestampType,
)


def _struct(**fields):
    return StructType([StructField(name, kind) for name, kind in fields.items()])


SAMPLE_TABLES = {
    "region": _struct(r_regionkey=IntegerType(), r_name=StringType()),
    "nation": _struct(n_nationkey=IntegerType(), n_name=StringType(), n_regionkey=IntegerType()),
    "customer": _struct(c_custkey=LongType(), c_name=StringType(), c_nationkey=IntegerType(),
                        c_acctbal=DoubleType(), c_mktsegment=StringType()),
    "supplier": _struct(s_suppkey=LongType(), s_name=StringType(), s_nationkey=IntegerType(),
                        s_acctbal=DoubleType()),
    "part": _struct(p_partkey=LongType(), p_name=StringType(), p_brand=StringType(),
                    p_type=StringType(), p_size=IntegerType(), p_retailprice=DoubleType()),
    "orders": _struct(o_orderkey=LongType(), o_custkey=LongType(), o_orderstatus=StringType(),
                      o_totalprice=DoubleType(), o_orderdate=TimestampNTZType(),
                      o_orderpriority=StringType()),
    "lineitem": _struct(l_orderkey=LongType(), l_partkey=LongType(), l_suppkey=LongType(),
                        l_linenumber=IntegerType(), l_quantity=DoubleType(),
                        l_extendedprice=DoubleType(), l_discount=DoubleType(), l_tax=DoubleType(),
                        l_returnflag=StringType(), l_linestatus=StringType(),
                        l_shipdate=TimestampNTZType()),
    "events": _struct(event_id=LongType(), ts=TimestampNTZType(), user_id=LongType(),
                      event_type=StringType(), value=DoubleType(), props=StringType()),
    "documents": _struct(doc_id=LongType(), text=StringType(), lang=StringType(),
                         source=StringType(), n_chars=LongType()),
    "embeddings": _struct(vec_id=LongType(), embedding=ArrayType(FloatType()), label=IntegerType()),
    "pages": _struct(page_id=LongType(), url=StringType(), html=StringType()),
    "benchmark": _struct(item_id=LongType(), text=StringType()),
    "labels": _struct(doc_id=LongType(), quality=IntegerType(), toxic=IntegerType()),
    "conversations": _struct(conv_id=LongType(), turn=LongType(), role=StringType(),
                             text=StringType()),
}

EVENT_PROPS = _struct(k=LongType())

# Advertising campaign as it arrives in the value of a queue message.
CAMPAIGN_MESSAGE = _struct(
    restaurant_id=LongType(), adv_campaign_id=LongType(), adv_campaign_content=StringType(),
    adv_campaign_owner=StringType(), adv_campaign_owner_contact=StringType(),
    adv_campaign_datetime_start=TimestampType(), adv_campaign_datetime_end=TimestampType(),
    datetime_created=TimestampType(),
)

ORDER_PRODUCT = _struct(id=StringType(), name=StringType(), category=StringType())

# Nested restaurant order as it arrives in the value of a queue message.
ORDER_MESSAGE = _struct(payload=_struct(
    id=StringType(), date=TimestampType(), status=StringType(), cost=DoubleType(),
    payment=DoubleType(),
    user=_struct(id=StringType(), name=StringType(), login=StringType()),
    restaurant=_struct(id=StringType(), name=StringType()),
    products=ArrayType(ORDER_PRODUCT),
))

# Order line sent on from the vault loader to the counter loader.
ORDER_LINE_MESSAGE = _struct(
    h_order_pk=StringType(), h_user_pk=StringType(), h_product_pk=StringType(),
    productname=StringType(), h_category_pk=StringType(), category_name=StringType(),
    status=StringType(),
)

CITY_FILE = _struct(id=IntegerType(), city=StringType(), lat=StringType(), lng=StringType())
