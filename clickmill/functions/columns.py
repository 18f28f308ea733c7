"""Column builders: safe ratios, calendar helpers and the decision tables."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmill.schemas import MIN_EVENT_DATE, OTHER_DAY

Dates = Column | str


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(
    numerator: Column | str, denominator: Column | str, places: int = 2, factor: int = 1
) -> Column:
    """`factor * numerator / denominator`, rounded half away from zero; 0 unless denominator > 0.

    The last digit comes from a whole-number division, so that nothing is rounded twice, and the
    ratio is published as a double.
    """
    top = _col(numerator).cast("decimal(28,6)")
    bottom = _col(denominator).cast("decimal(22,3)")
    doubled = F.abs(top) * F.lit(2 * factor * 10**places)
    digits = F.call_function("div", doubled + bottom, bottom * F.lit(2))
    signed = F.when(top < 0, -digits).otherwise(digits)
    return F.when(bottom > 0, signed.cast("double") / F.lit(10**places)).otherwise(F.lit(0.0))


def percentage(part: Column | str, whole: Column | str, places: int = 2) -> Column:
    return safe_divide(part, whole, places, factor=100)


def start_of_week(day: Dates) -> Column:
    """Monday of the week."""
    return F.trunc(_col(day), "week")


def start_of_month(day: Dates) -> Column:
    return F.trunc(_col(day), "month")


def days_between(start: Dates, end: Dates) -> Column:
    return F.datediff(_col(end), _col(start))


def day_of_week(day: Dates) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_col(day)) - 1


def is_weekend(day: Dates) -> Column:
    return F.coalesce(F.dayofweek(_col(day)).isin(1, 7), F.lit(False))


def day_name(day: Dates) -> Column:
    """English day name, blank-padded to nine characters."""
    return F.rpad(F.date_format(_col(day), "EEEE"), 9, " ")


def time_of_day(hour: Column | str) -> Column:
    h = _col(hour)
    return (
        F.when(h.between(6, 11), "morning")
        .when(h.between(12, 14), "lunch")
        .when(h.between(15, 18), "afternoon")
        .when(h.between(19, 22), "evening")
        .otherwise("night")
    )


def user_segment(
    purchases: Column | str, active_days: Column | str, page_views: Column | str, idle: Column | str
) -> Column:
    """First rule that holds; `idle` is the number of days since the last event."""
    bought, days = _col(purchases), _col(active_days)
    return (
        F.when((bought >= 10) & (days >= 15), "power_user")
        .when((bought >= 3) & (days >= 5), "regular")
        .when(bought >= 1, "casual_buyer")
        .when(_col(page_views) >= 10, "window_shopper")
        .when(_col(idle) > 30, "churned")
        .otherwise("new_user")
    )


def lifecycle_stage(age: Column | str, idle: Column | str) -> Column:
    quiet = _col(idle)
    return (
        F.when(_col(age) <= 7, "new")
        .when(quiet <= 7, "active")
        .when(quiet <= 30, "at_risk")
        .otherwise("dormant")
    )


def label(name: Column | str) -> Column:
    """`add_to_cart` -> `Add To Cart`."""
    return F.initcap(F.replace(_col(name), F.lit("_"), F.lit(" ")))


def checked_day(event_date: Dates, until: Column | str) -> Column:
    """The day as a partition name if it lies between 2020 and `until`, else `other`.

    Wrong dates share one partition instead of opening one each.
    """
    last = (F.lit(until) if isinstance(until, str) else until).cast("timestamp_ntz").cast("date")
    known = _col(event_date).between(day(MIN_EVENT_DATE), last)
    return F.when(known, _col(event_date).cast("string")).otherwise(OTHER_DAY)


def day(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")
