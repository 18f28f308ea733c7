"""Raw-event frames derived from the star-schema tables (`events`, `part`, `customer`, ...).

Every event row is kept. User ids are split into six activity tiers (by the number in `props`), and
each user's days are mapped onto a life span of their own, so that cohorts, gaps between active
days, idle users and all segments occur. Only integer arithmetic decides anything.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NOW = "2024-03-26 00:00:00"
AS_OF = "2024-03-25"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("n") % n == 0


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n, m (user), ts, k, event_type, day, ... for every row of `events`."""
    return (
        _table(spark, sf_dir, "events")
        .selectExpr(
            "event_id AS n",
            "user_id AS u",
            "ts",
            "event_type AS kind",
            "CAST(regexp_extract(props, '([0-9]+)', 1) AS int) AS k",
            "datediff(CAST(ts AS date), DATE'2024-01-01') AS di",
        )
        .selectExpr(
            "*",
            "u * 6 + CASE WHEN k < 50 THEN 0 WHEN k < 75 THEN 1 WHEN k < 88 THEN 2"
            " WHEN k < 95 THEN 3 WHEN k < 98 THEN 4 ELSE 5 END AS m",
        )
        .selectExpr("*", "(m * 5) % 84 AS first_day", "1 + m % 4 AS stride")
        .selectExpr("*", "1 + (m * 11) % (84 - first_day) AS span")
        .selectExpr("*", "CAST(first_day + (di * span) div 30 div stride * stride AS int) AS day")
        .selectExpr(
            "n", "u", "m", "k", "day",
            "ts + make_dt_interval(day - di) AS event_timestamp",
            """CASE kind
                 WHEN 'view' THEN 'page_view'
                 WHEN 'click' THEN CASE WHEN m % 10 = 0 THEN 'purchase' ELSE 'click' END
                 WHEN 'signup' THEN 'add_to_cart'
                 WHEN 'purchase' THEN CASE WHEN m % 3 = 1 THEN 'page_view' ELSE 'purchase' END
                 ELSE CASE WHEN k % 3 = 0 THEN 'refund' ELSE 'cashback_earned' END
               END AS event_type""",
            "u * 10 + k % 10 AS part_key",
            "u * 10 + n % 4 AS customer_key",
        )
    )


def clean_events(
    spark: SparkSession, sf_dir: str, product: bool = True, place: bool = True
) -> DataFrame:
    """Typed raw events without faults, with the numeric id `n` in front.

    A query that uses no product or place columns leaves those joins out; the optimizer cannot, as
    it does not know that the lookup keys are unique. The columns are null then, and revenue too.
    """
    df = _base(spark, sf_dir)
    if product:
        part = _table(spark, sf_dir, "part").selectExpr(
            "p_partkey AS part_key", "p_name", "p_type", "CAST(p_retailprice AS decimal(12,2)) AS price"
        )
        df = df.join(part, "part_key", "left")
    else:
        df = df.selectExpr(
            "*", "CAST(NULL AS string) AS p_name", "CAST(NULL AS string) AS p_type",
            "CAST(NULL AS decimal(12,2)) AS price",
        )
    if place:
        places = (
            _table(spark, sf_dir, "customer")
            .join(_table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
            .join(_table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
            .selectExpr("c_custkey AS customer_key", "r_name AS country", "n_name AS city")
        )
        df = df.join(places, "customer_key", "left")
    else:
        df = df.selectExpr("*", "CAST(NULL AS string) AS country", "CAST(NULL AS string) AS city")
    return (
        df
        .withColumn(
            "qty",
            F.expr(
                "CASE WHEN event_type IN ('add_to_cart', 'purchase', 'refund') THEN 1 + n % 5 ELSE 0 END"
            ),
        )
        .selectExpr(
            "n",
            "concat('e', n) AS event_id",
            "concat('u', m) AS user_id",
            "event_type",
            "event_timestamp",
            "CAST(event_timestamp AS date) AS event_date",
            "concat('/', event_type, '/', part_key) AS page_url",
            "concat('p', part_key) AS product_id",
            "p_name AS product_name",
            "p_type AS product_category",
            "price AS product_price",
            "CAST(qty AS int) AS quantity",
            """CAST(CASE event_type WHEN 'purchase' THEN price * qty WHEN 'refund' THEN -price * qty
                 ELSE 0 END AS decimal(12,2)) AS revenue""",
            """CAST(CASE event_type WHEN 'cashback_earned' THEN (50 + n % 4950) * 0.01BD
                 WHEN 'refund' THEN -(n % 100) * 0.01BD ELSE 0 END AS decimal(12,2)) AS cashback_amount""",
            "CASE (n + m) % 5 WHEN 3 THEN 'desktop' WHEN 4 THEN 'tablet' ELSE 'mobile' END AS device_type",
            "CASE (n * 3 + m) % 4 WHEN 2 THEN 'Safari' WHEN 3 THEN 'Firefox' ELSE 'Chrome' END AS browser",
            "country",
            "city",
            "concat('s', m, '-', day) AS session_id",
            "CASE n % 4 WHEN 0 THEN 'direct' WHEN 1 THEN 'email' WHEN 2 THEN 'google.com' END AS referrer",
        )
    )


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed events with faults, extra copies (`copy` > 0) and the delivery day `file_date`."""
    shifted = F.expr(
        """CASE WHEN n % 89 = 0 THEN event_timestamp + make_dt_interval(400)
                WHEN n % 67 = 0 THEN event_timestamp - make_dt_interval(2000)
                ELSE event_timestamp END
           + make_dt_interval(0, IF(copy = 2, 1, 0))"""
    )
    copies = (
        F.when(_every(73), F.array(F.lit(0), F.lit(1)))
        .when(_every(101), F.array(F.lit(0), F.lit(2)))
        .otherwise(F.array(F.lit(0)))
    )
    money = "decimal(12,2)"
    return (
        clean_events(spark, sf_dir)
        .withColumn("file_date", F.col("event_date"))
        .withColumn("copy", F.explode(copies))
        .withColumns(
            {
                "user_id": F.when(~_every(97), F.col("user_id")),
                "event_type": F.when(_every(79), "")
                .when(_every(71), "swipe")
                .otherwise(F.col("event_type")),
                "event_timestamp": shifted,
                "event_date": shifted.cast("date"),
                "product_price": F.when(_every(83), -F.col("product_price"))
                .otherwise(F.col("product_price"))
                .cast(money),
                "quantity": F.when(~_every(107), F.col("quantity")),
                "revenue": F.when(~_every(103), F.col("revenue")),
                "device_type": F.when(~_every(43), F.col("device_type")),
                "city": F.when(~_every(37), F.col("city")),
            }
        )
    )


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty events as text cells, with unreadable cells added, and their `source_file`."""
    dirty = dirty_events(spark, sf_dir)
    text = {c: F.col(c).cast("string") for c in dirty.columns if c not in ("n", "copy", "file_date")}
    text["product_price"] = F.when(_every(61), "abc").otherwise(text["product_price"])
    text["quantity"] = F.when(_every(59), "").when(_every(127), "3000000000").otherwise(text["quantity"])
    text["event_timestamp"] = F.when(_every(53), "not-a-date").otherwise(text["event_timestamp"])
    text["user_id"] = F.when(_every(109), "  ").otherwise(text["user_id"])
    text["referrer"] = F.when(_every(47), "NA").otherwise(text["referrer"])
    return dirty.select(
        *[c.alias(name) for name, c in text.items()],
        F.concat(F.lit("events_"), F.col("file_date").cast("string"), F.lit(".csv")).alias("source_file"),
        F.col("file_date").cast("string").alias("source_path"),
        "file_date",
    )


def malformed_lines(text: DataFrame) -> DataFrame:
    """The raw rows as lines of CSV files, in one column that is named like their header. By the event's
    number some have two cells too many, some end after eight cells, some break within the quoted product name."""
    names = [c for c in text.columns if c not in ("source_file", "source_path")]
    n = F.substring("event_id", 2, 20).cast("long")
    quoted = F.concat(F.lit('"'), F.col("product_name"), F.lit(' one"'))
    cells = [F.coalesce(quoted if c == "product_name" else F.col(c), F.lit("")) for c in names]
    whole = F.concat_ws(",", *cells)
    at = names.index("product_name")
    halves = F.array(
        F.concat(F.concat_ws(",", *cells[:at]), F.lit(',"'), F.coalesce("product_name", F.lit(""))),
        F.concat(F.lit('one",'), F.concat_ws(",", *cells[at + 1 :])),
    )
    lines = (
        F.when(n % 131 == 0, F.array(F.concat(whole, F.lit(",more,cells"))))
        .when(n % 137 == 0, F.array(F.concat_ws(",", *cells[:8])))
        .when(n % 139 == 0, halves)
        .otherwise(F.array(whole))
    )
    return text.select(F.explode(lines).alias(",".join(names)))  # the column's name makes the header


def spelled_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows whose times are spelled by the event's number: ISO, day or month first, year first."""
    kinds = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd HH:mm", "dd.MM.yyyy HH:mm:ss", "M/d/yyyy H:mm:ss", "dd/MM/yyyy HH:mm"]
    kind = F.substring("event_id", 2, 20).cast("long") % 5
    at = F.col("event_timestamp").try_cast("timestamp")
    spelled = F.coalesce(*[F.when(kind == i, F.date_format(at, k)) for i, k in enumerate(kinds)])
    day = F.when(kind == 2, F.date_format(F.col("event_date").cast("date"), "d.M.yyyy"))
    return raw_text(spark, sf_dir).drop("file_date").withColumns(
        {"event_timestamp": F.coalesce(spelled, "event_timestamp"), "event_date": F.coalesce(day, "event_date")}
    )
