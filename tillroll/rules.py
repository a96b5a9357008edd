"""Cleansing rules, kept as data rather than code.

:class:`SilverRules` holds every value the silver layer substitutes.  The
defaults are the values of the original warehouse; callers may pass their
own (tests and the driver fixture add rules that match the test tables).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# These must equal the original warehouse's rules verbatim.
#   order date override:      order CA-2016-153927 -> 2016-08-12
#   invalid ship modes:       text 'null' and text '0'
#   derived ship modes:       'Same Day' (<= 1 day), 'Standard Class' (3 to 7
#                             days), 'Unknown' (anything else)
#   invalid country code:     '123' -> 'United States'
#   postal code:              city 'Burlington', state 'Vermont' -> '05401'
#   product name override:    OFF-AP-10002684 ->
#       'Acco 7-Outlet Masterpiece Power Center, Wihtout Fax/Phone Line Protection'
#   product name cleanup:     two spaces -> one space, single pass
#   on-time limit:            days_to_ship <= 5
#   seasons:                  Winter 12,1,2; Spring 3,4,5; Summer 6,7,8; Fall 9,10,11
#   default gold date range:  2016-01-01 to 2020-12-31
# ---------------------------------------------------------------------------
ORDER_DATE_OVERRIDES = {"CA-2016-153927": dt.date(2016, 8, 12)}
INVALID_SHIP_MODES = ("null", "0")
SAME_DAY_LABEL = "Same Day"
STANDARD_CLASS_LABEL = "Standard Class"
UNKNOWN_SHIP_MODE_LABEL = "Unknown"
SAME_DAY_MAX_DAYS = 1
STANDARD_CLASS_DAYS = (3, 7)
COUNTRY_FIXES = {"123": "United States"}
POSTAL_CODE_FIXES = {("Burlington", "Vermont"): "05401"}
PRODUCT_NAME_OVERRIDES = {
    "OFF-AP-10002684": "Acco 7-Outlet Masterpiece Power Center, Wihtout Fax/Phone Line Protection",
}
PRODUCT_NAME_SEARCH = "  "
PRODUCT_NAME_REPLACEMENT = " "
ON_TIME_MAX_DAYS = 5
SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}
DEFAULT_DATE_RANGE = (dt.date(2016, 1, 1), dt.date(2020, 12, 31))


@dataclass(frozen=True)
class SilverRules:
    """All substitution values of the silver layer."""

    order_date_overrides: dict = field(default_factory=lambda: dict(ORDER_DATE_OVERRIDES))
    invalid_ship_modes: tuple = INVALID_SHIP_MODES
    # The reader keeps the text 'null'; a NULL ship mode is left alone unless
    # this is set (the automated loader of the original turned 'null' into NULL
    # and then never repaired it).
    treat_null_as_invalid: bool = False
    same_day_max_days: int = SAME_DAY_MAX_DAYS
    standard_class_days: tuple = STANDARD_CLASS_DAYS
    same_day_label: str = SAME_DAY_LABEL
    standard_class_label: str = STANDARD_CLASS_LABEL
    unknown_label: str = UNKNOWN_SHIP_MODE_LABEL
    country_fixes: dict = field(default_factory=lambda: dict(COUNTRY_FIXES))
    postal_code_fixes: dict = field(default_factory=lambda: dict(POSTAL_CODE_FIXES))
    product_name_overrides: dict = field(default_factory=lambda: dict(PRODUCT_NAME_OVERRIDES))
    product_name_search: str = PRODUCT_NAME_SEARCH
    product_name_replacement: str = PRODUCT_NAME_REPLACEMENT

    def extended(self, **extra: dict) -> "SilverRules":
        """Return a copy whose dict-valued rules are extended with ``extra``."""
        updates = {}
        for name, values in extra.items():
            merged = dict(getattr(self, name))
            merged.update(values)
            updates[name] = merged
        return replace(self, **updates)
