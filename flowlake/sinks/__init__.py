"""Materializations on Parquet: view, table, delete+insert, merge, append-dedup, compaction."""

from flowlake.sinks.writers import (
    append_dedup, compact, create_view, delete_insert, materialize, merge, table_exists,
    write_table,
)

__all__ = ["append_dedup", "compact", "create_view", "delete_insert", "materialize", "merge",
           "table_exists", "write_table"]
