"""Hand-made rows."""

from datetime import date, timedelta

from pacecast import schema as S

STAY = date(2020, 3, 31)


def day(before, stay=STAY):
    return stay - timedelta(days=before)


def bookings(spark, rows):
    """rows: (transaction, hotel, stay, lead, status, revenue[, channel])"""
    full = [
        (t, h, stay, day(lead, stay), (rest[0] if rest else "WEB"), status, float(rev), 1.0)
        for t, h, stay, lead, status, rev, *rest in rows
    ]
    return spark.createDataFrame(full, S.BOOKINGS)


def transactions(spark, rows):
    return spark.createDataFrame(rows, S.TRANSACTIONS)


def statuses(spark):
    return spark.createDataFrame(
        [("confirmed", "Confirmed"), ("cancelled", "Cancelled"), ("cancelled", "No-show")], S.STATUSES
    )


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())
