"""SourceCatalog: logical relation name → DataFrame.

Reports never name physical tables.  They ask the catalog for a logical
relation (``"setting"``, ``"provider"``, ...).  Two constructors:

* ``SourceCatalog.from_tables`` — production: each logical name maps to a
  metastore table (``spark.table``) or a Parquet/Delta path.  Boolean flags
  that some warehouse views store as text are normalised to BOOLEAN once,
  at load, so report code never compares a flag with a string.
* ``SourceCatalog.from_testdata`` — the stand-ins of ``fixtures.py``
  derived from the generated test tables.

Both are lazy: a DataFrame is only a plan until an action runs.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrualkit.constants import WAREHOUSE_NAMES
from accrualkit.functions.casts import as_boolean
from accrualkit.plans.materialize import register_view
from accrualkit.session import application_id, checkpoint_dir
from accrualkit.sources.fixtures import FIXTURES
from accrualkit.sources.testdata import BaseTables

# Flags that are BOOLEAN in some warehouse views and 'TRUE'/'False' text in
# others; normalised to BOOLEAN at load.
BOOLEAN_FLAGS = {
    "provider": ("is_resource", "is_test", "is_bookable", "is_bookable_legacy"),
    "practice": ("is_test",),
    "location": ("is_virtual",),
    "provider_location_mapping": ("is_active",),
    "provider_location_snapshot_summary_month": ("is_active_beginning_of_month",),
    "opportunity_index": ("is_active", "is_currently_synced"),
    "provider_location_availability_summary_day": ("has_availability",),
    "appointment_summary": ("is_premium_booking",),
    "provider_explorer_day_week_vw": (
        "bookable_status",
        "bookable_status_beginning_of_week",
        "was_ever_previously_mp_bookable",
    ),
}


# Stand-in tables written once per application and scale-factor directory.
_STORED: dict[tuple[str, str], dict[str, DataFrame]] = {}
_STORE_LOCK = threading.RLock()


def normalise_flags(name: str, df: DataFrame) -> DataFrame:
    """Cast text-typed boolean flags of relation ``name`` to BOOLEAN."""
    fields = {f.name.lower(): f for f in df.schema.fields}
    replacements = {}
    for flag in BOOLEAN_FLAGS.get(name, ()):
        f = fields.get(flag)
        if f is not None and f.dataType.typeName() != "boolean":
            replacements[f.name] = as_boolean(F.col(f.name), f.dataType)
    return df.withColumns(replacements) if replacements else df


class SourceCatalog:
    def __init__(self, spark: SparkSession, loader, base: BaseTables | None = None):
        self.spark = spark
        self._loader = loader
        self._cache: dict[str, DataFrame] = {}
        self.base = base
        self.token = uuid.uuid4().hex[:8]

    @staticmethod
    def resolve(name: str) -> str:
        """Logical relation of a plain, schema-qualified or three-part name."""
        key = name.replace('"', "").replace("`", "").strip().lower()
        if key in WAREHOUSE_NAMES:
            return key
        for short, qualified in WAREHOUSE_NAMES.items():
            if key == qualified or key.count(".") == 2 and key.endswith("." + qualified):
                return short
        raise KeyError(f"unknown relation {name!r}")

    def __call__(self, name: str) -> DataFrame:
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        # Three-part, double-quoted or back-quoted upper-case names resolve
        # to the same logical relation (identifiers are case-insensitive).
        key = self.resolve(name)
        if key not in self._cache:
            self._cache[key] = normalise_flags(key, self._loader(key))
        return self._cache[key]

    def view(self, name: str) -> str:
        """Register relation ``name`` as a session temp view for SQL text.

        Returns the (catalog-unique) view name to use in ``spark.sql``.
        """
        df = self.table(name)
        view = f"{self.resolve(name)}_{self.token}"
        return register_view(df, view)

    @classmethod
    def from_tables(cls, spark: SparkSession, locations: Mapping[str, str] | None = None, fmt: str = "parquet"):
        """Production catalog.

        ``locations`` maps a logical name to a metastore table name or to a
        path (anything containing '/').  Unmapped names default to the
        warehouse name in ``WAREHOUSE_NAMES``.
        """
        locations = dict(locations or {})

        def load(name: str) -> DataFrame:
            target = locations.get(name, WAREHOUSE_NAMES[name])
            if "/" in target:
                return spark.read.format(fmt).load(target)
            return spark.table(target)

        return cls(spark, load)

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> "SourceCatalog":
        """Catalog over DataFrames already in hand (keyed by logical name)."""
        frames = dict(frames)
        return cls(spark, lambda name: frames[name])

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, store: bool = True) -> "SourceCatalog":
        """Catalog of the stand-ins derived from the test tables in ``sf_dir``.

        With ``store=True`` each stand-in is derived once per Spark
        application, written as Parquet under the shared checkpoint folder
        and read from there afterwards — the way the warehouse relations it
        stands for exist as stored tables — so reports are measured on their
        own plans rather than on re-deriving their inputs.
        """
        base = BaseTables(spark, sf_dir)
        app = application_id(spark)
        sf_key = os.path.abspath(sf_dir)
        stored = _STORED.setdefault((app, sf_key), {}) if store else None
        cat: SourceCatalog

        def load(name: str) -> DataFrame:
            if stored is None:
                return FIXTURES[name](base, cat.table)
            # one writer per stand-in, also when queries run in parallel threads
            with _STORE_LOCK:
                if name not in stored:
                    digest = hashlib.sha1(sf_key.encode()).hexdigest()[:10]
                    path = (
                        f"{checkpoint_dir(spark).rstrip('/')}/accrualkit-standins/{app}/{digest}/"
                        f"{name}-{uuid.uuid4().hex[:8]}"
                    )
                    FIXTURES[name](base, cat.table).write.parquet(path)
                    stored[name] = spark.read.parquet(path)
                return stored[name]

        cat = cls(spark, load, base)
        return cat
