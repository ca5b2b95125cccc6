from datetime import datetime, timedelta

T0 = datetime(2024, 3, 4, 10, 0, 0)  # a Monday, on a 5-minute boundary
EVENT = "image_id string, event_id string, event_type string, ts timestamp"


def at(seconds: float) -> datetime:
    return T0 + timedelta(microseconds=round(seconds * 1e6))


def events(spark, rows):
    """Rows of (image, type, seconds) with running event ids."""
    data = [(i, f"e{n:05d}", kind, at(s)) for n, (i, kind, s) in enumerate(rows)]
    return spark.createDataFrame(data, EVENT)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())
