"""stationlake: bike-share station snapshots as Spark DataFrames.

Feeds (JSON, batch or stream) and history files (pipe-delimited CSV) are
normalised to one typed schema, kept as snappy Parquet partitioned by UTC
ingest hour, compacted and registered safely, and queried over trailing
windows with partition pruning.  Every operator takes and returns
DataFrames; nothing is collected to the driver except bounded metadata
(file lists, partition specs).
"""

from stationlake.schemas import INFO_SCHEMA, PART_COLS, STATUS_SCHEMA, STATUS_TABLE_SCHEMA
from stationlake.session import build_session, scratch_dir

__all__ = [
    "INFO_SCHEMA",
    "PART_COLS",
    "STATUS_SCHEMA",
    "STATUS_TABLE_SCHEMA",
    "build_session",
    "scratch_dir",
]
