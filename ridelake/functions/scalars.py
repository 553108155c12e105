"""Column-level functions (JVM expressions only, so they stay inside
whole-stage codegen).

Each function takes SQL expression text (a column name is an expression)
and returns a ``Column``; the ``*_sql`` companion returns the text, so
functions compose into one expression that Spark parses once instead of
being assembled node by node over the Python<->JVM bridge.

Timestamps are TIMESTAMP_NTZ holding UTC wall-clock time. Arithmetic uses
NTZ subtraction / interval addition and text comes from the string cast:
``timestampdiff`` and ``date_format`` on NTZ values pass through the session
time zone and shift values that fall into a daylight-saving gap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These labels and bounds must equal the reference's output.
# ---------------------------------------------------------------------------
TIME_OF_DAY_BANDS = [  # (first hour, last hour, label); anything else -> "Night"
    (0, 5, "Late Night"),
    (6, 10, "Morning"),
    (11, 15, "Afternoon"),
    (16, 18, "Evening"),
]
TIME_OF_DAY_OTHER = "Night"
TIME_OF_DAY_LABELS = ["Late Night", "Morning", "Afternoon", "Evening", "Night"]
WEEKEND_DAYS = [1, 7]  # dayofweek numbering: 1 = Sunday ... 7 = Saturday
MAX_TRIP_SECONDS = 86400
QUALITY_FLAGS = ["valid", "missing_start_data", "missing_end_data",
                 "negative_duration", "zero_duration", "excessive_duration"]
SUPPLY_STATUSES = ["empty", "full", "no_historical_data", "normal"]
RIDEABLE_TYPES = ["classic_bike", "electric_bike"]
MEMBER_TYPES = ["member", "casual"]
OPEN_END_TEXT = "9999-12-31 23:59:59"  # valid_to of a current version
SOURCE_DATA_BATCH = "Batch"
# ---------------------------------------------------------------------------


def sql_str(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_value(value) -> str:
    """A SQL literal for a string, number or boolean."""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    return sql_str(str(value))


def ntz_sql(text: str) -> str:
    return f"CAST({sql_str(text)} AS TIMESTAMP_NTZ)"


EPOCH_SQL = ntz_sql("1970-01-01 00:00:00")


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_literal(text: str) -> Column:
    """A TIMESTAMP_NTZ literal independent of the session time zone and of
    ``spark.sql.timestampType``."""
    return F.lit(text).cast("timestamp_ntz")


def open_end() -> Column:
    return ntz_literal(OPEN_END_TEXT)


def utc_now() -> Column:
    """Current instant as UTC wall-clock TIMESTAMP_NTZ (one value per query)."""
    return F.expr("convert_timezone('UTC', CAST(current_timestamp() AS TIMESTAMP_NTZ))")


# ------------------------------------------------------------------ time arithmetic

def seconds_between_sql(start: str, end: str) -> str:
    return f"CAST(({end}) - ({start}) AS INTERVAL SECOND)"


def elapsed_seconds_sql(start: str, end: str) -> str:
    """Whole elapsed seconds, truncated toward zero, sign kept
    (0.9 s -> 2.1 s is 1 second, not 2)."""
    return f"CAST({seconds_between_sql(start, end)} AS BIGINT)"


def elapsed_seconds(start: str, end: str) -> Column:
    return F.expr(elapsed_seconds_sql(start, end))


def epoch_seconds_to_ts_sql(c: str) -> str:
    return f"{EPOCH_SQL} + ({c}) * INTERVAL '1' SECOND"


def text_to_utc(col: str) -> Column:
    """Timestamp text -> UTC wall clock (NTZ); NULL when malformed. An offset or
    ``Z`` in the text is honoured, text without one is taken as it stands."""
    return F.expr(
        f"CASE WHEN CAST({col} AS STRING) RLIKE ':[0-9]{{2}}([.][0-9]+)? ?(Z|[+-][0-9]{{2}}(:?[0-9]{{2}})?)$' "
        f"THEN timestampadd(MICROSECOND, unix_micros(try_cast({col} AS TIMESTAMP)), TIMESTAMP_NTZ'1970-01-01 00:00:00') "
        f"ELSE try_cast({col} AS TIMESTAMP_NTZ) END")


def epoch_seconds_to_ts(c: str) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ (UTC wall-clock)."""
    return F.expr(epoch_seconds_to_ts_sql(c))


def ts_to_epoch_seconds_sql(c: str) -> str:
    return elapsed_seconds_sql(EPOCH_SQL, c)


def ts_to_epoch_seconds(c: str) -> Column:
    """TIMESTAMP_NTZ (UTC wall-clock) -> whole epoch seconds (truncated)."""
    return F.expr(ts_to_epoch_seconds_sql(c))



def minutes_2dp_sql(seconds: str) -> str:
    """round(seconds / 60, 2) in exact decimal arithmetic, as double."""
    return f"CAST(ROUND(CAST(({seconds}) AS DECIMAL(38,9)) / 60, 2) AS DOUBLE)"


def minutes_2dp(seconds: str) -> Column:
    return F.expr(minutes_2dp_sql(seconds))


# ------------------------------------------------------------------ calendar labels

def ts_text_sql(c: str, micros: bool = False) -> str:
    """'yyyy-MM-dd HH:mm:ss[.SSSSSS]' from the zone-free string cast."""
    text = f"CAST(({c}) AS STRING)"
    head = f"substring({text}, 1, 19)"
    if not micros:
        return head
    frac = f"regexp_extract({text}, '[.]([0-9]+)$', 1)"
    return f"concat({head}, '.', rpad({frac}, 6, '0'))"


def ts_text(c: str, micros: bool = False) -> Column:
    return F.expr(ts_text_sql(c, micros))


def weekday_name_sql(ts: str) -> str:
    return f"date_format(to_date({ts}), 'EEEE')"


def weekday_name(ts: str) -> Column:
    """Full English weekday name (Monday ... Sunday), from the date part."""
    return F.expr(weekday_name_sql(ts))


def is_weekend_sql(ts: str) -> str:
    days = ", ".join(str(d) for d in WEEKEND_DAYS)
    return f"CASE WHEN dayofweek({ts}) IN ({days}) THEN true ELSE false END"


def is_weekend(ts: str) -> Column:
    """True on Saturday/Sunday; False otherwise, including a NULL timestamp."""
    return F.expr(is_weekend_sql(ts))


def time_of_day_sql(hour: str) -> str:
    arms = " ".join(f"WHEN ({hour}) BETWEEN {lo} AND {hi} THEN {sql_str(label)}"
                    for lo, hi, label in TIME_OF_DAY_BANDS)
    return f"CASE {arms} ELSE {sql_str(TIME_OF_DAY_OTHER)} END"


def time_of_day(hour: str) -> Column:
    """Hour band label; a NULL hour falls through to the catch-all label."""
    return F.expr(time_of_day_sql(hour))


def year_month_sql(ts: str) -> str:
    return f"date_format(to_date({ts}), 'yyyyMM')"


def year_month(ts: str) -> Column:
    """yyyyMM label of a timestamp's date."""
    return F.expr(year_month_sql(ts))


def day_key_sql(ts: str) -> str:
    return f"date_format(to_date({ts}), 'yyyyMMdd')"


def day_key(ts: str) -> Column:
    """yyyyMMdd routing key of a timestamp."""
    return F.expr(day_key_sql(ts))


# ------------------------------------------------------------------ other

def safe_divide(num: Column | str, den: Column | str) -> Column:
    """NULL instead of an error or infinity when the divisor is zero."""
    return F.try_divide(col_(num).cast("double"), col_(den))


def surrogate_key(key: str, ts: str) -> Column:
    """Hex md5 of key text + microsecond timestamp text; NULL if either part is
    NULL. The timestamp text format is fixed so the key is engine-independent."""
    return F.expr(f"md5(concat(CAST({key} AS STRING), {ts_text_sql(ts, micros=True)}))")


def data_quality_flag_sql(start_id: str, start_lat: str, start_lng: str, end_id: str,
                          end_lat: str, end_lng: str, duration_seconds: str) -> str:
    d = duration_seconds
    return ("CASE "
            f"WHEN {start_id} IS NULL OR {start_lat} IS NULL OR {start_lng} IS NULL "
            "THEN 'missing_start_data' "
            f"WHEN {end_id} IS NULL OR {end_lat} IS NULL OR {end_lng} IS NULL "
            "THEN 'missing_end_data' "
            f"WHEN {d} < 0 THEN 'negative_duration' "
            f"WHEN {d} = 0 THEN 'zero_duration' "
            f"WHEN {d} > {MAX_TRIP_SECONDS} THEN 'excessive_duration' "
            "ELSE 'valid' END")


def data_quality_flag(*cols: str) -> Column:
    """Ordered row-level quality label; a NULL duration falls through to
    ``valid`` once both ends are present."""
    return F.expr(data_quality_flag_sql(*cols))


def supply_status_sql(bikes: str, docks: str, avg_hist: str) -> str:
    return (f"CASE WHEN {bikes} = 0 THEN 'empty' WHEN {docks} = 0 THEN 'full' "
            f"WHEN {avg_hist} IS NULL THEN 'no_historical_data' ELSE 'normal' END")


def supply_status(bikes: str, docks: str, avg_hist: str) -> Column:
    """empty -> full -> no_historical_data -> normal, first match wins."""
    return F.expr(supply_status_sql(bikes, docks, avg_hist))
