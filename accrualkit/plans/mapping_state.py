"""The mapping history kept up to date from month to month.

``mapping_history_flat`` pairs the n-th create with the n-th delete of a (sync
DB, location) over the whole log.  ``MappingState`` stores what a new batch of
events needs, so a month reads its own events and the open rows instead:

* ``keys``: for each key, how many creates and deletes there are, and the last
  time of either kind;
* ``open``: rows of one side only (a create without its delete, or a delete
  whose create has not come yet) with their ordinal;
* ``closed``: pairs, which later events on time cannot change.

A merge numbers the batch by itself, adds the counts of the key, and lets the
new events meet the open rows on (key, ordinal).  An event that is older than
the last one of its kind and key would shift ordinals: it is late, and its key
is taken anew from the whole log.  ``closed`` only grows (a folder for each
version); the pairs that a recomputed key had before carry a version below the
key's ``since`` and no longer count.

Each version is complete in the shared folder before it is used, so a failed
merge leaves the one before as it was.  Rows with a null database or location
never pair, as in the full history: their creates stay open for good.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrualkit.constants import ADDED, DELETED
from accrualkit.operators.ordinal import occurrence_number
from accrualkit.plans.materialize import reuse

KEYS = ["sync_db_id", "location_id"]
#: Null times come last in the numbering.
_NEVER = "TIMESTAMP_NTZ '9999-12-31 23:59:59'"


def _numbered(events: DataFrame) -> DataFrame:
    """KEYS, is_create, ts, occurrence of events (KEYS, is_create, ts)."""
    return occurrence_number(events, ["is_create", *KEYS], "ts", "occurrence", co_locate=KEYS)


def _pairs(halves: DataFrame) -> DataFrame:
    """KEYS, occurrence, created, deleted and which sides are there, of halves (KEYS, occurrence, is_create, ts)."""
    side = lambda flag, value: F.max(F.when(F.col("is_create") == flag, value))
    return halves.groupBy(*KEYS, "occurrence").agg(
        side(True, F.col("ts")).alias("created"), side(False, F.col("ts")).alias("deleted"),
        F.coalesce(side(True, F.lit(True)), F.lit(False)).alias("has_create"),
        F.coalesce(side(False, F.lit(True)), F.lit(False)).alias("has_delete"),
    )


def _counts(events: DataFrame) -> DataFrame:
    side = lambda how, flag, value: how(F.when(F.col("is_create") == flag, value))
    time = F.coalesce("ts", F.expr(_NEVER))
    one = F.lit(1)
    return events.groupBy(*KEYS).agg(
        side(F.count, True, one).alias("creates"), side(F.count, False, one).alias("deletes"),
        side(F.max, True, time).alias("last_create"), side(F.max, False, time).alias("last_delete"),
        side(F.min, True, time).alias("first_create"), side(F.min, False, time).alias("first_delete"),
    )


@dataclass(frozen=True)
class MappingState:
    """One version of the stored state under ``path`` (a shared folder)."""

    spark: SparkSession
    path: str
    version: int
    created_types: tuple[str, ...] = (ADDED,)
    deleted_types: tuple[str, ...] = (DELETED,)

    @classmethod
    def start(
        cls, events: DataFrame, path: str, created_types: Sequence[str] = (ADDED,), deleted_types: Sequence[str] = (DELETED,)
    ) -> MappingState:
        """Version 0 from the ``location_events`` so far."""
        state = cls(events.sparkSession, path.rstrip("/"), 0, tuple(created_types), tuple(deleted_types))
        keyed, loose = state._kinds(events)
        state._write(_pairs(_numbered(keyed)), loose, _counts(keyed).withColumn("since", F.lit(0)))
        return state

    def _kinds(self, events: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(events that can pair, creates that cannot), as KEYS, is_create, ts."""
        used = events.filter(F.col("event_type").isin(*self.created_types, *self.deleted_types))
        kinds = used.select(*KEYS, F.col("event_type").isin(*self.created_types).alias("is_create"), "ts")
        whole = F.col("sync_db_id").isNotNull() & F.col("location_id").isNotNull()
        return kinds.filter(whole), kinds.filter(~whole & F.col("is_create"))

    def _write(self, pairs: DataFrame, loose: DataFrame, keys: DataFrame) -> None:
        # a pair is complete for good; one side alone is open
        rows = pairs.select(*KEYS, "occurrence", "created", "deleted", "has_create", "has_delete")
        lone = loose.select(*KEYS, F.lit(None).cast("bigint").alias("occurrence"), F.col("ts").alias("created"),
                            F.lit(None).cast("timestamp_ntz").alias("deleted"), F.lit(True).alias("has_create"), F.lit(False).alias("has_delete"))
        both = rows.unionByName(lone).withColumn("kind", F.when(F.col("has_create") & F.col("has_delete"), "closed").otherwise("open"))
        both.write.partitionBy("kind").mode("overwrite").parquet(f"{self.path}/rows/version={self.version}")
        keys.select(*KEYS, "creates", "deletes", "last_create", "last_delete", "since").write.mode("overwrite").parquet(
            f"{self.path}/keys/version={self.version}"
        )

    _ROWS = "sync_db_id long, location_id string, occurrence long, created timestamp_ntz, deleted timestamp_ntz, has_create boolean, has_delete boolean, kind string"
    _KEYS = "sync_db_id long, location_id string, creates long, deletes long, last_create timestamp_ntz, last_delete timestamp_ntz, since int"

    def _rows(self, version: int, kind: str) -> DataFrame:
        rows = self.spark.read.schema(self._ROWS).parquet(f"{self.path}/rows/version={version}")
        return rows.filter(F.col("kind") == kind).drop("kind")

    def keys(self) -> DataFrame:
        return self.spark.read.schema(self._KEYS).parquet(f"{self.path}/keys/version={self.version}")

    def merge(self, batch: DataFrame, log: DataFrame) -> MappingState:
        """The next version: ``batch`` are the new ``location_events``, ``log`` all of them with the batch.

        ``log`` is read for the keys of late events only.
        """
        after = MappingState(self.spark, self.path, self.version + 1, self.created_types, self.deleted_types)
        keyed, loose = self._kinds(batch)
        old, new = self.keys(), _counts(keyed).withColumnsRenamed({c: f"new_{c}" for c in ("creates", "deletes", "last_create", "last_delete")})
        # null comparisons: a key without a last create, or a batch without a create, is not late on that side
        sides = [F.coalesce(F.col(f"first_{k}") < F.col(f"last_{k}"), F.lit(False)) for k in ("create", "delete")]
        late = sides[0] | sides[1]
        joined = old.join(new, KEYS, "full").select(
            *KEYS, late.alias("late"),
            *[(F.coalesce(c, F.lit(0)) + F.coalesce(f"new_{c}", F.lit(0))).alias(c) for c in ("creates", "deletes")],
            *[F.coalesce(c, F.lit(0)).alias(f"old_{c}") for c in ("creates", "deletes")],
            *[F.greatest(c, f"new_{c}").alias(c) for c in ("last_create", "last_delete")],
            F.coalesce("since", F.lit(0)).alias("since"), F.col("new_creates").isNotNull().alias("touched"),
        )
        keys = reuse(joined)
        again = keys.filter("late").select(*KEYS)

        # on time: ordinals go on from the counts so far
        before = keys.filter("touched AND NOT late").select(*KEYS, "old_creates", "old_deletes")
        offset = F.when(F.col("is_create"), F.col("old_creates")).otherwise(F.col("old_deletes"))
        fresh = _numbered(keyed).join(before, KEYS).select(*KEYS, (F.col("occurrence") + offset).alias("occurrence"), "is_create", "ts")
        still_open = self._rows(self.version, "open")
        lone = still_open.filter("occurrence IS NULL").select(*KEYS, F.lit(True).alias("is_create"), F.col("created").alias("ts"))
        waiting = still_open.filter("occurrence IS NOT NULL").join(again, KEYS, "left_anti").select(
            *KEYS, "occurrence", F.col("has_create").alias("is_create"), F.when(F.col("has_create"), F.col("created")).otherwise(F.col("deleted")).alias("ts")
        )
        # late: the key anew, from the whole log
        whole, _ = self._kinds(log)
        anew = _numbered(whole.join(again, KEYS, "left_semi")).select(*KEYS, "occurrence", "is_create", "ts")
        pairs = _pairs(reduce(DataFrame.unionByName, [fresh, waiting, anew]))
        kept = keys.withColumn("since", F.when(F.col("late"), F.lit(after.version)).otherwise(F.col("since")).cast("int"))
        after._write(pairs, loose.unionByName(lone.select(*loose.columns)), kept)
        return after

    def history(self) -> DataFrame:
        """The rows of ``mapping_history_flat`` over all events so far."""
        out = ("sync_db_id", "location_id", F.col("created").alias("created_date_utc"), F.col("deleted").alias("deleted_date_utc"))
        opened = self._rows(self.version, "open").filter("has_create").select(*out)
        closed = [self._rows(v, "closed").withColumn("version", F.lit(v)) for v in range(self.version + 1)]
        since = self.keys().filter("since > 0").select(*KEYS, "since")
        kept = reduce(DataFrame.unionByName, closed).join(since, KEYS, "left").filter("since IS NULL OR version >= since")
        return opened.unionByName(kept.select(*out))
