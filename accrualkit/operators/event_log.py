"""Operators over the key/value settings event log.

The log holds one row per change: ``(setting_key_id, entity_id,
setting_value, event_type, event_timestamp_utc)``.  Two keys matter:

* key 18 — entity = sync database id, value = PMS id
* key 16 — entity = location (monolith id), value = sync database id

Values are text, so every conversion is a ``try_cast``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrualkit.constants import ADDED, DELETED, LOCATION_SETTING_KEY, PMS_SETTING_KEY, UPDATED  # noqa: F401
from accrualkit.functions.casts import try_bigint
from accrualkit.operators.bloom import choose
from accrualkit.operators.ordinal import occurrence_number

ENTITY = "entity_id"
VALUE = "setting_value"
TS = "event_timestamp_utc"


def latest_setting(
    setting: DataFrame,
    pms: DataFrame,
    key_id: int = PMS_SETTING_KEY,
    value_type: str = "bigint",
    latest_types: Sequence[str] = (ADDED, UPDATED),
) -> DataFrame:
    """PMS of each sync database as of its latest Added/Updated event.

    Returns DISTINCT ``(sync_db_id, pms_application, pms_id)``.  Every key-18
    row stamped with the entity's latest Added/Updated timestamp counts
    (whatever its own event type), so timestamp ties yield several rows.

    Plan: one partial/final aggregate for the latest timestamp per entity,
    then an equi-join on (entity, timestamp) — both columns are join keys,
    so a busy entity is spread over tasks by timestamp — and a join to the
    small PMS dimension.
    """
    at_latest = rows_at_latest(setting, key_id, latest_types).select(
        ENTITY, F.col(VALUE).try_cast(value_type).alias("_pms_key")
    )
    return (
        at_latest.join(pms, pms["pms_id"] == F.col("_pms_key"))
        .select(try_bigint(ENTITY).alias("sync_db_id"), pms["pms_application"], pms["pms_id"])
        .distinct()
    )


def rows_at_latest(
    setting: DataFrame, key_id: int = PMS_SETTING_KEY, latest_types: Sequence[str] = (ADDED, UPDATED)
) -> DataFrame:
    """Rows of ``key_id`` stamped with their entity's latest ``latest_types`` time.

    Group-wise latest by MAX + join back; ties are kept.  The join is on
    (entity, timestamp), so a busy entity is spread over tasks by timestamp.
    """
    rows = setting.filter(F.col("setting_key_id") == key_id).select(ENTITY, VALUE, "event_type", TS)
    latest = (
        rows.filter(F.col("event_type").isin(*latest_types))
        .groupBy(ENTITY)
        .agg(F.max(TS).alias("_latest_ts"))
        .withColumnRenamed(ENTITY, "_latest_entity")
    )
    return rows.join(
        latest, (F.col(ENTITY) == F.col("_latest_entity")) & (F.col(TS) == F.col("_latest_ts"))
    ).select(ENTITY, VALUE, "event_type", TS)


def mapping_events(setting: DataFrame, event_types: Sequence[str], key_id: int = LOCATION_SETTING_KEY) -> DataFrame:
    """Location ↔ sync-database events: ``(sync_db_id, location_id, ts)``."""
    return setting.filter((F.col("setting_key_id") == key_id) & F.col("event_type").isin(*event_types)).select(
        try_bigint(VALUE).alias("sync_db_id"), F.col(ENTITY).alias("location_id"), F.col(TS).alias("ts")
    )


def mapping_history_flat(
    setting: DataFrame,
    created_types: Sequence[str] = (ADDED,),
    deleted_types: Sequence[str] = (DELETED,),
    sync_dbs: DataFrame | None = None,
) -> DataFrame:
    """Pair the n-th create with the n-th delete of each (sync DB, location).

    Output ``(sync_db_id, location_id, created_date_utc, deleted_date_utc)``,
    one row per create; ``deleted_date_utc`` is NULL when there is no n-th
    delete.  Pairing is by ordinal only, so a delete may predate its create.
    A NULL sync DB (malformed value) never pairs.  ``sync_dbs`` (a column
    ``sync_db_id``) restricts the log to those databases before it is
    numbered; the database is part of the numbering key, so the rows of the
    remaining ones are the same.
    """
    return paired_occurrences(setting, created_types, deleted_types, sync_dbs).drop("occurrence")


def location_events(setting: DataFrame, event_types: Sequence[str] | None = None) -> DataFrame:
    """``(sync_db_id, location_id, ts, event_type)`` of the location mapping log."""
    wanted = F.col("setting_key_id") == LOCATION_SETTING_KEY
    if event_types is not None:
        wanted &= F.col("event_type").isin(*event_types)
    return setting.filter(wanted).select(
        try_bigint(VALUE).alias("sync_db_id"), F.col(ENTITY).alias("location_id"), F.col(TS).alias("ts"), "event_type"
    )


def store_location_events(setting: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """The mapping log as a table bucketed by (sync DB, location) and sorted by time.

    ``pair_events(..., placed=True)`` then numbers, pairs and collapses it
    without any shuffle, as often as it is read.  One key is in one bucket, so
    buckets are as uneven as the keys; ``path`` is a shared folder.
    """
    spark = setting.sparkSession
    writer = location_events(setting).repartition(buckets, "sync_db_id", "location_id").write.mode("overwrite").format("parquet")
    writer = writer.bucketBy(buckets, "sync_db_id", "location_id").sortBy("sync_db_id", "location_id", "ts")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return spark.table(table)


def paired_occurrences(
    setting: DataFrame,
    created_types: Sequence[str] = (ADDED,),
    deleted_types: Sequence[str] = (DELETED,),
    sync_dbs: DataFrame | None = None,
) -> DataFrame:
    """``mapping_history_flat`` keeping the pairing ordinal as ``occurrence``.

    ``sync_dbs`` (pass it materialised) chooses databases where the log is read.
    """
    events = location_events(setting, [*created_types, *deleted_types])
    if sync_dbs is not None:
        events = choose(events, "sync_db_id", sync_dbs, "sync_db_id")
    return pair_events(events, created_types, deleted_types)


def pair_events(
    events: DataFrame, created_types: Sequence[str] = (ADDED,), deleted_types: Sequence[str] = (DELETED,), placed: bool = False
) -> DataFrame:
    """The n-th create with the n-th delete of each (sync DB, location) of ``location_events``.

    Creates and deletes are numbered in one pass (the event kind is part of
    the numbering key), and the n-th create meets the n-th delete in one
    aggregation on (sync DB, location, n) — each such group holds at most
    one create and one delete — instead of a join between two separately
    numbered streams.  Equality never matches a NULL sync DB or location,
    so those creates keep a NULL delete, as in the equi-join formulation.
    Numbering, pairing and the collapse of the history all accept a
    partitioning by (sync DB, location), so the log is shuffled once, and not
    at all if it is ``placed`` so already.
    """
    if set(created_types) & set(deleted_types):
        raise ValueError("created and deleted event types must be disjoint")
    keys = ["sync_db_id", "location_id"]
    kinds = events.filter(F.col("event_type").isin(*created_types, *deleted_types)).select(
        *keys, "ts", F.col("event_type").isin(*created_types).alias("_is_create")
    )
    numbered = occurrence_number(kinds, ["_is_create", *keys], "ts", "occurrence", co_locate=None if placed else keys)
    create, delete = F.col("_is_create"), ~F.col("_is_create")
    paired = numbered.groupBy(*keys, "occurrence").agg(
        F.count(F.when(create, F.lit(1))).alias("_creates"),
        F.max(F.when(create, F.col("ts"))).alias("created_date_utc"),
        F.max(F.when(delete, F.col("ts"))).alias("_deleted"),
    )
    matchable = F.col("sync_db_id").isNotNull() & F.col("location_id").isNotNull()
    return paired.filter(F.col("_creates") > 0).select(
        "sync_db_id",
        "location_id",
        "occurrence",
        "created_date_utc",
        F.when(matchable, F.col("_deleted")).alias("deleted_date_utc"),
    )


def mapping_history_collapsed(setting: DataFrame, sync_dbs: DataFrame | None = None) -> DataFrame:
    """One row per (sync DB, location): first create and last paired delete.

    Creates include updates.  ``deleted_date_utc`` stays set once any create
    was paired with a delete, even if the location was re-added later.
    """
    flat = mapping_history_flat(setting, created_types=(ADDED, UPDATED), sync_dbs=sync_dbs)
    return flat.groupBy("sync_db_id", "location_id").agg(
        F.min("created_date_utc").alias("created_date_utc"),
        F.max("deleted_date_utc").alias("deleted_date_utc"),
    )
