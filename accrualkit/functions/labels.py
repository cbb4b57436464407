"""Label mappings used by the provider roster."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from accrualkit.constants import (
    MANUAL_LABEL,
    ONE_WAY_LABEL,
    ONE_WAY_SYNC_TYPE,
    TWO_WAY_LABEL,
    TWO_WAY_SYNC_TYPES,
)


def resolve_pms(sync_id: Column, sync_type: Column, synced_pms: Column, listed_pms: Column) -> Column:
    """PMS to report for a provider.

    With no sync at all (id, type and synced PMS all NULL) fall back to the
    PMS listed on the profile; otherwise report the synced PMS even when it
    is NULL.  This is deliberately not ``coalesce``.
    """
    no_sync = sync_id.isNull() & sync_type.isNull() & synced_pms.isNull()
    return F.when(no_sync, listed_pms).otherwise(synced_pms)


def sync_type_label(sync_type: Column) -> Column:
    """Two Way / One Way / Manual; unknown and NULL types count as Manual."""
    return (
        F.when(sync_type.isin(*TWO_WAY_SYNC_TYPES), F.lit(TWO_WAY_LABEL))
        .when(sync_type == ONE_WAY_SYNC_TYPE, F.lit(ONE_WAY_LABEL))
        .otherwise(F.lit(MANUAL_LABEL))
    )
