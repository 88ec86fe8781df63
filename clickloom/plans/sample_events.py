"""The ``events`` table seen as raw clickstream, with drift, gaps, bad payloads and retries.

The table itself has none of these, so the queries read it through this fixed mapping;
``RAW_ONCE_SQL`` is the same mapping for the SQL side of the comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The one day whose cut payloads are left as they are where all others are mended.
CUT_DAY = "2024-01-17"

EVENT_NAMES = {
    "view": "page_viewed",
    "click": "product_added_to_cart",
    "signup": "checkout_started",
    "purchase": "checkout_completed",
    "error": "email_filled_on_popup",
}


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a file stream."""
    schema = events_table(spark, sf_dir).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw(events_table(spark, sf_dir))


def as_raw(table: DataFrame) -> DataFrame:
    """event_id, timestamp, event_date, client_id, clientId, event_name, page_url, referrer, event_data."""
    e, day = F.col("event_id"), F.to_date("ts")
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    text = e.cast("string")
    drift = F.lit("2024-01-11").cast("date")
    every = F.when(day == F.lit("2024-01-15").cast("date"), 6).otherwise(12)
    name = F.create_map(*[F.lit(x) for pair in EVENT_NAMES.items() for x in pair])[F.col("event_type")]
    shop = "https://shop.example.com/p"
    url = (
        F.when(e % 11 == 0, F.concat(F.lit(f"{shop}?utm_source=AdNet&utm_medium=CPC&utm_campaign=c"), (e % 5).cast("string")))
        .when(e % 11 == 1, f"{shop}?utm_source=facebook&utm_medium=paidsocial&utm_campaign=spring")
        .when(e % 11 == 2, f"{shop}?utm_medium=email&utm_source=klaviyo")
        .when(e % 11 == 3, f"{shop}?utm_medium=banner")
        .when(e % 11 == 4, f"{shop}?utm_medium=affiliate&utm_source=blog#top")
        .otherwise(F.concat(F.lit(f"{shop}/"), (e % 50).cast("string")))
    )
    referrer = (
        F.when(day == F.lit("2024-01-20").cast("date"), None)
        .when(e % 6 == 0, "https://www.Google.com/search?q=x")
        .when(e % 6 == 1, "https://m.facebook.com/")
        .when(e % 6 == 2, "")
        .when(e % 6 == 4, "https://www.reddit.com/r/x")
        .when(e % 6 == 5, "https://news.example.org/a")
    )
    amount = F.col("value").cast("decimal(12,2)").cast("string")
    purchase = (
        F.when(e % 40 == 0, '{"order_id":"O1"')
        .when(e % 41 == 0, '{"value":0,"revenue":12.5,"order_id":"O2"}')
        .when(e % 43 == 0, '{"transaction_id":null,"total":9.75}')
        .otherwise(F.concat(F.lit('{"transaction_id":"T'), (e - e % 3).cast("string"), F.lit('","value":'), amount, F.lit("}")))
    )
    item_name = F.when(e % 7 == 0, "").otherwise(',"item_name":"n"')
    payload = (
        F.when(F.col("event_type") == "purchase", purchase)
        .when(
            F.col("event_type") == "click",
            F.concat(F.lit('{"item_id":"I'), (e % 20).cast("string"), F.lit('"'), item_name, F.lit("}")),
        )
        .when(F.col("event_type") == "signup", '{"step":1}')
        .when(F.col("event_type") == "view", "{}")
    )
    rows = table.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("timestamp"),
        day.alias("event_date"),
        F.when((day < drift) & (e % 50 != 0), user).alias("client_id"),
        F.when((day >= drift) & (e % every != 0), user).alias("clientId"),
        name.alias("event_name"),
        url.alias("page_url"),
        referrer.alias("referrer"),
        payload.alias("event_data"),
        # A retried event arrives twice: each copy is a full row of its own.
        F.explode(F.when(e % 97 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


# ``base`` is the table with ``d`` (day) and ``u`` (user text); the two identity columns are
# named apart because SQL names do not differ by case.
RAW_ONCE_SQL = """
  SELECT event_id, ts AS "timestamp", d AS event_date,
    CASE WHEN d < DATE '2024-01-11' AND event_id % 50 <> 0 THEN u END AS cid_old,
    CASE WHEN d >= DATE '2024-01-11'
          AND event_id % (CASE WHEN d = DATE '2024-01-15' THEN 6 ELSE 12 END) <> 0 THEN u END AS cid_new,
    CASE event_type WHEN 'view' THEN 'page_viewed' WHEN 'click' THEN 'product_added_to_cart'
      WHEN 'signup' THEN 'checkout_started' WHEN 'purchase' THEN 'checkout_completed'
      WHEN 'error' THEN 'email_filled_on_popup' END AS event_name,
    CASE event_id % 11
      WHEN 0 THEN 'https://shop.example.com/p?utm_source=AdNet&utm_medium=CPC&utm_campaign=c' || CAST(event_id % 5 AS VARCHAR)
      WHEN 1 THEN 'https://shop.example.com/p?utm_source=facebook&utm_medium=paidsocial&utm_campaign=spring'
      WHEN 2 THEN 'https://shop.example.com/p?utm_medium=email&utm_source=klaviyo'
      WHEN 3 THEN 'https://shop.example.com/p?utm_medium=banner'
      WHEN 4 THEN 'https://shop.example.com/p?utm_medium=affiliate&utm_source=blog#top'
      ELSE 'https://shop.example.com/p/' || CAST(event_id % 50 AS VARCHAR) END AS page_url,
    CASE WHEN d = DATE '2024-01-20' THEN NULL ELSE
      CASE event_id % 6 WHEN 0 THEN 'https://www.Google.com/search?q=x' WHEN 1 THEN 'https://m.facebook.com/'
        WHEN 2 THEN '' WHEN 4 THEN 'https://www.reddit.com/r/x' WHEN 5 THEN 'https://news.example.org/a' END
    END AS referrer,
    CASE event_type
      WHEN 'purchase' THEN CASE
        WHEN event_id % 40 = 0 THEN '{"order_id":"O1"'
        WHEN event_id % 41 = 0 THEN '{"value":0,"revenue":12.5,"order_id":"O2"}'
        WHEN event_id % 43 = 0 THEN '{"transaction_id":null,"total":9.75}'
        ELSE '{"transaction_id":"T' || CAST(event_id - event_id % 3 AS VARCHAR) || '","value":'
             || CAST(CAST("value" AS DECIMAL(12,2)) AS VARCHAR) || '}' END
      WHEN 'click' THEN '{"item_id":"I' || CAST(event_id % 20 AS VARCHAR) || '"'
             || CASE WHEN event_id % 7 = 0 THEN '' ELSE ',"item_name":"n"' END || '}'
      WHEN 'signup' THEN '{"step":1}' WHEN 'view' THEN '{}' END AS event_data
  FROM base
"""
