"""Row types of the tables. Coordinates are two doubles; times are UTC timestamps."""

from pyspark.sql import types as T

MENU_ITEM = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("description", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

LISTING = T.StructType(
    [
        T.StructField("platform", T.StringType()),
        T.StructField("platform_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
        T.StructField("cuisine_tags", T.ArrayType(T.StringType())),
        T.StructField("rating", T.DoubleType()),
        T.StructField("review_count", T.LongType()),
        T.StructField("price_bucket", T.StringType()),
        T.StructField("delivery_fee", T.DoubleType()),
        T.StructField("estimated_delivery_min", T.IntegerType()),
        T.StructField("is_promoted", T.BooleanType()),
        T.StructField("menu_items", T.ArrayType(MENU_ITEM)),
        T.StructField("market", T.StringType()),
        T.StructField("raw_url", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
    ]
)

# Decimal types the persisted table uses for what is a double in flight.
PERSISTED_DECIMALS = {"rating": "decimal(3,2)", "delivery_fee": "decimal(6,2)"}

MENU_ITEM_ROW = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("platform_merchant_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("price", T.DecimalType(8, 2)),
        T.StructField("description", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

CRAWL_RUN = T.StructType(
    [
        T.StructField("platform", T.StringType()),
        T.StructField("market", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("merchants_found", T.LongType()),
        T.StructField("errors", T.LongType()),
        T.StructField("error_detail", T.StringType()),
    ]
)

PAGE_EVENT = T.StructType(
    [
        T.StructField("platform", T.StringType()),
        T.StructField("market", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("minio_key", T.StringType()),
        T.StructField("scraped_at", T.DoubleType()),
    ]
)
