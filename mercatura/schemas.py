"""Explicit schemas of the tables the jobs read and write; nothing is inferred from data."""

from pyspark.sql import types as T

STRING, INT, BIGINT, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, BOOLEAN = T.DateType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


STAGED_LINE = _struct(
    bill_no=STRING, line_no=INT, product_code=STRING, qty=DOUBLE, unit_price=DOUBLE,
    line_type=STRING, raw_ts=STRING, store_id=STRING, business_date=DATE,
)
LAKE_LINE = _struct(
    bill_no=STRING, line_no=INT, product_code=STRING, qty=DOUBLE, unit_price=DOUBLE,
    line_type=STRING, raw_ts=STRING, business_date=DATE, store_id=STRING, year_month=STRING,
)
CATEGORY = _struct(
    category_id=STRING, category_name=STRING, department=STRING, gst_rate=DOUBLE
)
PRODUCT = _struct(
    product_sk=BIGINT, product_code=STRING, product_name=STRING, category_id=STRING,
    brand=STRING, pack_size=STRING, uom=STRING, valid_from=DATE, valid_to=DATE,
    is_current=BOOLEAN,
)
FINANCE_MONTH = _struct(month=STRING, revenue_inr=DOUBLE)
NOTICE = _struct(
    notice_id=STRING, portal_id=STRING, published_at=STRING, title=STRING, body=STRING,
    estimated_value=DOUBLE, closing_date=STRING,
)
LABELLED_PAIR = _struct(notice_id_a=STRING, notice_id_b=STRING, label=STRING)
TRUTH = _struct(
    monthly_net_revenue_in_folder=T.MapType(STRING, DOUBLE),
    finance_notes=T.MapType(STRING, STRING),
    notices=BIGINT,
    opportunities=BIGINT,
    cluster_size_hist=T.MapType(STRING, BIGINT),
    true_duplicate_pairs=BIGINT,
    total_possible_pairs=BIGINT,
    nodal_portals=T.ArrayType(STRING),
    label_same=BIGINT,
    label_different=BIGINT,
)
