"""Where report inputs come from: warehouse tables or test-data stand-ins."""

from accrualkit.sources.catalog import WAREHOUSE_NAMES, SourceCatalog, normalise_flags
from accrualkit.sources.testdata import BASE_TABLES, BaseTables

__all__ = ["WAREHOUSE_NAMES", "SourceCatalog", "normalise_flags", "BASE_TABLES", "BaseTables"]
