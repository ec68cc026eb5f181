"""Column type coercion by a mapping, including spreadsheet serial dates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbers import NUMBER_TEXT

# Serial day 0 and the accepted serial range (1900 to about 2119).
SERIAL_ORIGIN = "1899-12-30"
SERIAL_MIN, SERIAL_MAX = 1, 80000
SERIAL_TEXT = r"^[-+]?\d+(\.\d+)?\z"
MICROS_PER_DAY = 86_400_000_000

# Spellings of true and false.
TRUE_TEXTS = ("true", "t", "yes", "y", "1")
FALSE_TEXTS = ("false", "f", "no", "n", "0")

# Texts that are not ISO are read as a day and a clock time. Formats of the day, by its shape once month names are cut to three
# letters, commas are gone and years have four digits. A failing parse costs an exception per row, so only formats that
# can fit are tried.
DAY_FORMATS = {
    r"^\d{1,2}/\d{1,2}/\d{4}\z": "M/d/yyyy",
    r"^\d{1,2}-\d{1,2}-\d{4}\z": "M-d-yyyy",
    r"^\d{1,2}\.\d{1,2}\.\d{4}\z": "M.d.yyyy",
    r"^\d{4}/\d{1,2}/\d{1,2}\z": "yyyy/M/d",
    r"^\d{1,2} [A-Za-z]{3} \d{4}\z": "d MMM yyyy",
    r"^\d{1,2}-[A-Za-z]{3}-\d{4}\z": "d-MMM-yyyy",
    r"^[A-Za-z]{3} \d{1,2} \d{4}\z": "MMM d yyyy",
    r"^\d{4}-\d{1,2}-\d{1,2}\z": "yyyy-M-d",
    r"^\d{8}\z": "yyyyMMdd",
}
MONTH_WORDS = (
    r"(?i)\b(?:(jan)(?:uary)?|(feb)(?:ruary)?|(mar)(?:ch)?|(apr)(?:il)?|(may)|(jun)e?|(jul)y?|(aug)(?:ust)?|(sep)(?:t(?:ember)?)?|"
    r"(oct)(?:ober)?|(nov)(?:ember)?|(dec)(?:ember)?)\b\.?"
)
CLOCK = r"^(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,6}))?)?(?: *([AaPp])[Mm])?\z"
# Two-digit years from 69 on are of the 20th century.
SHORT_YEARS = ((r"6[9]|[7-9]\d", "19"), (r"[0-5]\d|6[0-8]", "20"))

# Type names of the mapping and what they stand for.
TYPE_NAMES = {
    "date": "date",
    "datetime": "timestamp", "datetime64": "timestamp", "timestamp": "timestamp",
    "string": "string", "str": "string",
    "int": "int", "int64": "int", "integer": "int",
    "float": "float", "float64": "float", "double": "float",
    "bool": "bool", "boolean": "bool",
}
PYTHON_TYPES = {int: "int", float: "float", bool: "bool", str: "string"}
# Further dtype names and their Spark type.
OTHER_NAMES = {
    "object": "string", "category": "string", "int8": "tinyint", "int16": "smallint", "int32": "int",
    "float32": "float", "datetime64[ns]": "timestamp_ntz",
}


def serial_to_timestamp(c: Column, tz: str | None = None) -> Column:
    """Spreadsheet serial (number or numeric text) to a timestamp, NULL out of range or for other text.

    Without `tz` the result is zoneless. With `tz` it is the instant of that local time, NULL where the clock
    change skips or repeats it.
    """
    text = F.trim(c.cast("string"))
    serial = F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
    in_range = serial.between(SERIAL_MIN, SERIAL_MAX)
    origin = F.lit(SERIAL_ORIGIN).cast("date").cast("timestamp_ntz")
    stamp = F.when(in_range, F.timestamp_add("MICROSECOND", F.round(serial * MICROS_PER_DAY).cast("long"), origin))
    return stamp if tz is None else localize(stamp, tz)


def localize(stamp: Column, tz: str) -> Column:
    """Instant of a zoneless local time in `tz`; NULL in a clock-change gap or overlap."""
    local = stamp.cast("timestamp")
    instant = F.to_utc_timestamp(local, tz)
    ok = F.from_utc_timestamp(instant, tz) == local
    for minutes in (-60, -30, 30, 60):
        other = F.timestamp_add("MINUTE", F.lit(minutes), instant)
        ok = ok & (F.from_utc_timestamp(other, tz) != local)
    return F.when(ok, instant)


def _clock_micros(clock: Column) -> Column:
    """Microseconds of a time of day as text; 0 for no text, NULL for one that is no time."""
    part = lambda i: F.regexp_extract(clock, CLOCK, i)
    hour, minute, second = (F.coalesce(part(i).try_cast("int"), F.lit(0)) for i in (1, 2, 3))
    half = F.lower(part(5))
    hours = F.when(half == "", hour).otherwise(hour % 12 + F.when(half == "p", 12).otherwise(0))
    possible = clock.rlike(CLOCK) & (minute < 60) & (second < 60) & F.when(half == "", hour < 24).otherwise(hour.between(1, 12))
    micros = ((hours * 60 + minute) * 60 + second).cast("long") * 1_000_000 + F.rpad(part(4), 6, "0").try_cast("long")
    return F.when(clock == "", F.lit(0).cast("long")).when(possible, micros)


def _text_to_timestamp(text: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(text, MONTH_WORDS, "$1$2$3$4$5$6$7$8$9$10$11$12"), ",", " ")
    plain = F.regexp_replace(plain, r"\s+", " ")
    for digits, century in SHORT_YEARS:
        year = rf"^(?<day>\d{{1,2}}(?<gap>[-/ ])(?:\d{{1,2}}|[A-Za-z]{{3}})\k<gap>)(?<year>{digits})(?= |\z)"
        plain = F.regexp_replace(plain, year, "${day}" + century + "${year}")
    day, clock = (F.regexp_extract(plain, r"^(.*?)(?:[ T](\d{1,2}:\d{2}.*))?\z", i) for i in (1, 2))
    tries = [F.when(day.rlike(shape), F.try_to_timestamp(day, F.lit(form)).cast("timestamp_ntz")) for shape, form in DAY_FORMATS.items()]
    return F.coalesce(text.try_cast("timestamp_ntz"), F.timestamp_add("MICROSECOND", _clock_micros(clock), F.coalesce(*tries)))


def _is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def to_timestamp_column(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp_ntz")
    if _is_numeric(dtype):
        return serial_to_timestamp(c)
    text = F.trim(c.cast("string"))
    # Numeric text must never reach the date parser, which would read '47521' as a year.
    eight_digits = text.rlike(r"^\d{8}\z")
    parsed = _text_to_timestamp(F.when(~text.rlike(SERIAL_TEXT) | eight_digits, text))
    return F.when(text.rlike(SERIAL_TEXT) & ~eight_digits, serial_to_timestamp(text)).otherwise(parsed)


def to_date_column(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DateType):
        return c
    return to_timestamp_column(c, dtype).cast("date")


def to_float_column(c: Column, dtype: T.DataType) -> Column:
    if _is_numeric(dtype) or isinstance(dtype, T.BooleanType):
        return c.cast("double")
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def to_int_column(c: Column, dtype: T.DataType, fractional: str = "error") -> Column:
    """Long column. A value with a fraction raises (`error`) or becomes NULL (`null`)."""
    if fractional not in ("error", "null"):
        raise ValueError("fractional must be one of: 'error', 'null'")
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return c.cast("long")
    text = F.trim(c.cast("string"))
    number = to_float_column(c, dtype)
    # Whole numbers written without a point keep all their digits; a double would lose those past 2^53.
    whole = F.coalesce(text.try_cast("long"), number.try_cast("long"))
    if fractional == "null":
        return F.when(text.rlike(r"^[+-]?\d+\z") | (number == F.floor(number)), whole)
    broken = F.raise_error(F.concat(F.lit("cannot convert a fractional value to an integer: "), text)).cast("long")
    return F.when(number.isNull(), None).when(number == F.floor(number), whole).otherwise(broken)


def to_bool_column(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return c
    text = F.lower(F.trim(c.cast("string")))
    return F.when(text.isin(*TRUE_TEXTS), True).when(text.isin(*FALSE_TEXTS), False)


def _target_name(target) -> str:
    if isinstance(target, type):
        return PYTHON_TYPES.get(target, target.__name__)
    return str(target).strip()


def coerce_columns(
    df: DataFrame, mapping: Mapping[str, object], *, on_missing: str = "ignore", fractional: str = "error"
) -> DataFrame:
    """New frame with the mapped columns converted in one projection; unparseable values become NULL.

    Targets: date, datetime, string, int, float, bool, the Python types int/float/bool/str, other dtype names and
    any Spark type in DDL form (those cast strictly). Unknown targets raise TypeError; unknown columns raise
    KeyError when `on_missing` is "raise".
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    converted: dict[str, Column] = {}
    for name, target in mapping.items():
        if name not in fields:
            if on_missing == "raise":
                raise KeyError(f"the table has no column {name}")
            continue
        c, dtype, spelled = F.col(f"`{name}`"), fields[name], _target_name(target)
        kind = TYPE_NAMES.get(spelled.lower())
        if kind == "date":
            converted[name] = to_date_column(c, dtype)
        elif kind == "timestamp":
            converted[name] = to_timestamp_column(c, dtype)
        elif kind == "string":
            converted[name] = c.cast("string")
        elif kind == "int":
            converted[name] = to_int_column(c, dtype, fractional)
        elif kind == "float":
            converted[name] = to_float_column(c, dtype)
        elif kind == "bool":
            converted[name] = to_bool_column(c, dtype)
        else:
            ddl = OTHER_NAMES.get(spelled.lower(), spelled)
            try:
                converted[name] = c.cast(T.DataType.fromDDL(ddl))
            except Exception as error:
                raise TypeError(f"{target!r}, asked for {name}, is no known type: {error}") from error
    return df.withColumns(converted) if converted else df
