from brindle.sinks.delivery import deliver, delivered_files, read_delivered, sweep
from brindle.sinks.files import (
    compact_files,
    overwrite_partitions,
    read_sequence_file,
    write_json,
    write_sequence_file,
    write_text,
)
from brindle.sinks.tables import (
    append_table,
    drop_table,
    insert_by_name,
    overwrite_table_partitions,
    overwrite_table_partitions_sql,
    partition_columns,
    replace_table,
    save_bucketed,
    save_bucketed_apart,
    save_partitioned,
    for_each_partition,
    table_partitions,
)

__all__ = [
    "append_table",
    "compact_files",
    "deliver",
    "delivered_files",
    "drop_table",
    "for_each_partition",
    "insert_by_name",
    "overwrite_partitions",
    "overwrite_table_partitions",
    "overwrite_table_partitions_sql",
    "partition_columns",
    "read_delivered",
    "read_sequence_file",
    "replace_table",
    "save_bucketed",
    "save_bucketed_apart",
    "save_partitioned",
    "sweep",
    "table_partitions",
    "write_json",
    "write_sequence_file",
    "write_text",
]
