"""Pure column expressions shared by the batch and the streaming jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow import fixed

DAY = "yyyy-MM-dd"
HOUR = "HH"


# --- time ---------------------------------------------------------------------

def day_text(ts: Column) -> Column:
    return F.date_format(ts, DAY)


def hour_text(ts: Column) -> Column:
    return F.date_format(ts, HOUR)


def day_hour_text(epoch_millis: Column) -> Column:
    """Epoch milliseconds as ``yyyy-MM-dd HH``."""
    return F.date_format(F.timestamp_millis(epoch_millis), f"{DAY} {HOUR}")


def text_day(create_time: Column) -> Column:
    """Day part of a ``yyyy-MM-dd HH:mm:ss`` text; null when the hour is missing."""
    return F.when(F.length(create_time) >= 13, F.substring(create_time, 1, 10))


def text_hour(create_time: Column) -> Column:
    return F.when(F.length(create_time) >= 13, F.substring(create_time, 12, 2))


def previous_day(day: Column) -> Column:
    return F.date_format(F.date_sub(F.to_date(day), 1), DAY)


def day_before(day: str) -> str:
    """The same for a day known when the query is written."""
    return (dt.date.fromisoformat(day) - dt.timedelta(days=1)).isoformat()


def today(at: Column | None = None) -> Column:
    return F.date_format(F.current_timestamp() if at is None else at, DAY)


def on_days(df: DataFrame, ts: str, first: str, last: str) -> Column:
    """Rows whose timestamp falls on ``first`` .. ``last``.

    Written as a range on the raw column (not on its formatted day), so that the scan can skip
    row groups by their statistics.
    """
    kind = df.schema[ts].dataType.simpleString()
    after = (dt.date.fromisoformat(last) + dt.timedelta(days=1)).isoformat()
    return (F.col(ts) >= F.lit(first).cast(kind)) & (F.col(ts) < F.lit(after).cast(kind))


def minute_key(mid: Column, epoch_millis: Column) -> Column:
    """``<mid>_<epoch minute>``."""
    device = F.coalesce(mid.cast("string"), F.lit("null"))
    return F.concat_ws("_", device, F.floor(epoch_millis / 60000).cast("string"))


def whole_years(birthday: Column, as_of: Column) -> Column:
    """Completed years of 365 days between a ``yyyy-MM-dd`` birthday and a date."""
    days = F.datediff(as_of, F.try_to_date(birthday, DAY))
    return (days / 365).cast("int")


def micros(spark: SparkSession, period: str) -> int:
    """The microseconds of a period such as ``10 minutes``."""
    start = F.timestamp_micros(F.lit(0))
    return spark.range(1).select(F.unix_micros(start + F.expr(f"INTERVAL {period}"))).first()[0]


# --- text ---------------------------------------------------------------------

def mask_phone(tel: Column) -> Column:
    return F.concat(F.substring(tel, 1, 4), F.lit(fixed.PHONE_MASK))


# A word is a run of letters and digits; of scripts written without blanks, one character.
_WORD = (r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]"
         r"|[[\p{L}\p{M}\p{N}]&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}]]+")


def tokens(text: Column) -> Column:
    """Lower-case words of a text, split at everything that is no letter or digit."""
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def has_all_terms(text: Column, keyword: str | None) -> Column:
    """Every word of ``keyword`` is a word of ``text``.

    ``None`` matches everything, a keyword without words nothing.  The keyword is split by the
    same expression as the text; as a literal it is split once, when the plan is made.
    """
    if keyword is None:
        return F.lit(True)
    wanted = F.array_distinct(tokens(F.lit(keyword)))
    return (F.size(wanted) > 0) & (F.size(F.array_except(wanted, tokens(text))) == 0)


def route_key(event_type: Column, table_name: Column) -> Column:
    return F.concat(event_type, F.lit("->"), table_name)


# --- numbers ------------------------------------------------------------------

def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_long(text: Column) -> Column:
    return text.try_cast("bigint")


def to_int(text: Column) -> Column:
    return text.try_cast("int")


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def percent_share(part: Column, total: Column) -> Column:
    """Share in percent with one decimal, rounded half up; 0 when there is nothing to share."""
    return F.when(total > 0, F.floor(part * 1000.0 / total + 0.5) / 10).otherwise(F.lit(0.0))


# --- costly columns -------------------------------------------------------------

def with_computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed once per row.

    A filter or a join key on a plain column is pushed below its projection, which repeats the
    computation; it is not pushed below a generator, and this one gives one row for each row.
    """
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode(F.array(value)).alias(name))


# --- JSON ---------------------------------------------------------------------

def json_field(text: Column, name: str) -> Column:
    return F.get_json_object(text, f"$.{name}")


def json_with(text: Column, name: str, value: Column) -> Column:
    """A JSON object with one field added or replaced; all other fields keep their values.

    Needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` (see ``session.configure``).
    """
    fields = F.from_json(text, "map<string,variant>")
    return F.to_json(F.map_concat(fields, F.create_map(F.lit(name), value.cast("variant"))))
