"""Raw text to typed bronze rows, and the rows it turns away."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.schemas import BRONZE, BRONZE_ROWS, MONEY, NULL_TOKENS

REQUIRED = ["event_id", "user_id", "event_type", "event_timestamp", "event_date"]
REQUIRED_TEXT = ["event_id", "user_id", "event_type"]
AMOUNTS = ["product_price", "revenue", "cashback_amount"]
# How times and dates may be spelled beside ISO, in the order they are tried.
DAY_FORMATS = ["yyyy/M/d", "d.M.yyyy", "M/d/yyyy", "d/M/yyyy"]
TIME_OF_DAY = "[ H:mm[:ss[.SSSSSS]]]"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def normalize_nulls(df: DataFrame) -> DataFrame:
    """Cells that spell a missing value become null."""
    texts = [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)) for c in texts})


def coerce(df: DataFrame) -> DataFrame:
    """Unreadable or missing numbers become 0; unreadable times and dates become null."""
    have = set(df.columns)
    typed = {c: F.coalesce(fitting(c), F.lit(0).cast(MONEY)) for c in AMOUNTS if c in have}
    if "quantity" in have:
        typed["quantity"] = F.coalesce(fitting("quantity"), F.lit(0))
    if "event_timestamp" in have:
        typed["event_timestamp"] = read_time("event_timestamp", "timestamp_ntz")
    if "event_date" in have:
        typed["event_date"] = read_time("event_date", "date")
    return df.withColumns(typed)


def _spelled(name: str, day_format: str) -> Column:
    return F.try_to_timestamp(F.col(name), F.lit(day_format + TIME_OF_DAY)).cast("timestamp_ntz")


def ambiguous(name: str) -> Column:
    """A cell that is one time with the month first and another with the day first."""
    month_first, day_first = _spelled(name, "M/d/yyyy"), _spelled(name, "d/M/yyyy")
    return F.coalesce(month_first != day_first, F.lit(False))


def read_time(name: str, kind: str) -> Column:
    """The cell as an ISO time or date, else by the first format that fits; null if none does or the cell is
    ambiguous. The formats are only tried on cells that ISO cannot read, and ISO is tried once."""
    cell = F.col(name)
    first = F.coalesce(*[_spelled(name, f) for f in DAY_FORMATS]).cast(kind)
    return F.coalesce(cell.try_cast(kind), F.when(cell.isNotNull() & ~ambiguous(name), first))


def unclear_times() -> Column:
    """A reason for each cell whose month and day cannot be told apart."""
    return F.array(
        *[
            F.when(F.col(c).try_cast(kind).isNull() & F.col(c).isNotNull() & ambiguous(c), F.lit(f"ambiguous_{c}"))
            for c, kind in (("event_timestamp", "timestamp_ntz"), ("event_date", "date"))
        ]
    )


def add_lineage(df: DataFrame, ingested_at: Column | str, batch_id: str) -> DataFrame:
    """Load time and batch; the file names come with the raw rows."""
    return df.withColumns(
        {
            "ingested_at": F.lit(ingested_at).cast("timestamp_ntz"),  # F.lit leaves a column as it is
            "batch_id": F.lit(batch_id),
        }
    )


def fitting(name: str) -> Column:
    """A number cell in its column's type; null if it is unreadable or does not fit."""
    if name == "quantity":
        return F.col(name).try_cast("decimal(20,0)").try_cast("int")
    return F.col(name).try_cast(MONEY)


def overflows() -> Column:
    """A reason for each number that can be read but is too large for its column; only cells that gave no
    value are matched."""
    return F.array(
        *[
            F.when(fitting(c).isNull() & F.col(c).rlike(NUMBER), F.lit(f"overflow_{c}"))
            for c in (*AMOUNTS, "quantity")
        ]
    )


def problems() -> Column:
    """All reasons against a typed row: required cells without a value, or with blanks only. A cell that begins
    with a visible ASCII character is not searched."""
    no_value = [(F.col(c).isNull(), f"null_{c}") for c in REQUIRED]
    only_blanks = [
        (~F.ascii(c).between(33, 126) & ~F.col(c).rlike(r"(?U)\S"), f"blank_{c}") for c in REQUIRED_TEXT
    ]
    return F.array(*[F.when(wrong, F.lit(reason)) for wrong, reason in no_value + only_blanks])


def typed_rows(raw: DataFrame, ingested_at: Column | str, batch_id: str) -> DataFrame:
    """Every raw row in the bronze schema, with the reasons to turn it away (comma-separated)."""
    fault = F.col("line_fault") if "line_fault" in raw.columns else F.lit(None).cast("string")
    return (
        raw.transform(normalize_nulls)
        .withColumn("seen_in_text", F.concat(overflows(), unclear_times(), F.array(fault)))
        .transform(coerce)
        .transform(add_lineage, ingested_at, batch_id)
        .withColumn("reject_reason", F.array_join(F.concat(problems(), "seen_in_text"), ","))
        .select(BRONZE_ROWS.fieldNames())
    )


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason") == "").select(BRONZE.fieldNames())


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason") != "")


def reject_counts(rows: DataFrame) -> DataFrame:
    """Rejected rows per source file and reason."""
    return rejected(rows).groupBy("source_file", "reject_reason").agg(
        F.count(F.lit(1)).alias("rejected_rows")
    )
