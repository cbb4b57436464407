import datetime as dt

from pyspark.sql import functions as F

SETTING_SCHEMA = "setting_key_id int, entity_id string, setting_value string, event_type string, event_timestamp_utc timestamp_ntz"


def ts(day: int, hour: int = 0) -> dt.datetime:
    return dt.datetime(2024, 1, day, hour)


def setting_df(spark, rows):
    return spark.createDataFrame(rows, SETTING_SCHEMA)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as text (what ``df.explain`` prints)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def lit_ts(d: dt.datetime):
    return F.lit(d.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
