"""Path expressions (X11, X12, K4's mapping).

Column versions run on Spark (for path tables built from ``_metadata``);
the plain-Python twins are used by the driver when it moves a bounded list
of files.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The trash folder name and the legacy bare-path table prefix.
TRASH_DIR = "trash"
LEGACY_PREFIX = "station_status"

# First path segment (the bucket), with an optional URI scheme in front.
_HEAD = r"^((?:[A-Za-z][A-Za-z0-9+.\-]*://)?[^/]*)(?:/|$)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trash_path(col) -> Column:
    """K4/X11: ``bucket/rest`` -> ``bucket/trash/rest`` (scheme kept)."""
    return F.regexp_replace(_c(col), _HEAD, f"$1/{TRASH_DIR}/")


def trash_path_py(path: str) -> str:
    return re.sub(_HEAD, lambda m: f"{m.group(1)}/{TRASH_DIR}/", path, count=1)


def last_segment(col) -> Column:
    """The text after the last ``/``."""
    return F.element_at(F.split(_c(col), "/"), -1)


def legacy_hour_path(year="year", month="month", day="day", hour="hour",
                     prefix: str = LEGACY_PREFIX) -> Column:
    """Bare layout ``prefix/YYYY/MM/DD/HH`` from the partition columns."""
    return F.concat_ws("/", F.lit(prefix), _c(year), _c(month), _c(day), _c(hour))


def hive_hour_path(year="year", month="month", day="day", hour="hour") -> Column:
    """``year=YYYY/month=MM/day=DD/hour=HH`` (the layout this library writes)."""
    return F.concat(
        F.lit("year="), _c(year), F.lit("/month="), _c(month),
        F.lit("/day="), _c(day), F.lit("/hour="), _c(hour),
    )
