from tierlake.sinks.parquet import WriteReport, reports_frame, write_leaf, write_partitioned, write_table
from tierlake.sinks.versions import Commit, CommitConflict, VersionedTables

__all__ = ["Commit", "CommitConflict", "VersionedTables", "WriteReport", "reports_frame", "write_leaf", "write_partitioned", "write_table"]
