"""One explicit StructType per table, checked when a table is read or written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_str, _int, _dbl, _date, _bool = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.BooleanType()

BOOKINGS = _s(
    ("TransactionID", T.LongType()), ("HotelID", _str), ("stay_date", _date), ("confirmation_date", _date),
    ("channel", _str), ("status", _str), ("revenue", _dbl), ("rooms", _dbl),
)
TRANSACTIONS = _s(("TransactionID", T.LongType()), ("cancellation_date", _date))
HOTELS = _s(("HotelID", _str), ("HotelName", _str), ("Country", _str), ("State", _str))
STATUSES = _s(("scenario", _str), ("status", _str))
HOLIDAYS = _s(("date", _date), ("Country", _str), ("State", _str), ("name", _str))
EXCLUSIONS = _s(
    ("HotelID", _str), ("pipeline", _str), ("ts", _date), ("range_start", _date), ("range_end", _date),
)
MODEL_VERSIONS = _s(("model_name", _str), ("version", _int), ("stage_dev", _str), ("stage_prod", _str))

# The published forecast row, in this order.
FORECAST = _s(
    ("HotelID", _str), ("run_id", _str), ("stay_date", _date), ("booking_date", _date), ("model_version", _int),
    ("timestamp", T.TimestampType()), ("pms_sync_off", _bool), ("forecast_currency", _str), ("day_index", _int),
    ("y_med", _dbl), ("model_name", _str), ("y_upper", _dbl), ("y_lower", _dbl), ("y_med_raw", _dbl),
    ("y_upper_raw", _dbl), ("y_lower_raw", _dbl), ("status", _str), ("message", _str),
)

QUANTILE_PARAMS = _s(
    ("HotelID", _str), ("day_ahead", _int), ("target_lead", _int), ("offsets", T.ArrayType(_dbl)),
)
LINEAR_PARAMS = _s(
    ("HotelID", _str), ("day_ahead", _int), ("target_lead", _int), ("intercepts", T.ArrayType(_dbl)),
    ("coefs", T.ArrayType(T.ArrayType(_dbl))), ("path_coefs", T.ArrayType(T.ArrayType(_dbl))),
    ("converged", T.ArrayType(_bool)),
)


def validate(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Return df with exactly the columns of schema; missing or mistyped columns raise."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    wrong = [
        f"{f.name}: {have[f.name].simpleString()} is not {f.dataType.simpleString()}"
        for f in schema.fields
        if f.name in have and have[f.name].simpleString() != f.dataType.simpleString()
    ]
    if missing or wrong:
        raise ValueError(f"table does not fit its schema; missing {missing}, mistyped {wrong}")
    return df.select(*schema.fieldNames())
