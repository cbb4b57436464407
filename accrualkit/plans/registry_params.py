"""Parameter values of the registered report runs.

The months the report scripts name are moved to the months the generated
data covers; PMS lists and selectors are the scripts' own.
"""

from __future__ import annotations

from accrualkit.params import DateWindow, PmsSelector

# Report runs (PMS lists, selectors, months) per script family.
ALLSCRIPTS_APPS = ("AllScriptsAPI",)
ATHENA_APPS = ("Athena", "AthenaAPI")
PROGNOCIS_APPS = ("CAPI_PrognoCIS",)
DENTICON = PmsSelector.by_name("Denticon")
EAGLESOFT = PmsSelector.by_id(11, 12)
NEXTECH = PmsSelector.by_id(10)
ACTIVE_MONTH = "2024-03-01"
ACTIVE_MONTH_EARLY = "2024-01-01"
ADDRESS_WINDOW = DateWindow.of("2023-12-01", "2023-12-31")
BOOKING_START = "2024-01-01"
BOOKING_END_NEXT_MONTH = "2024-02-01"
BOOKING_END_LAST_DAY = "2024-01-31"
NO_AVAILABILITY_SINCE = "2023-12-01"
NO_AVAILABILITY_EXCLUDED = ("P3", "P27", "P105", "")
