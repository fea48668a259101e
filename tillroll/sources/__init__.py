from tillroll.sources.lake import (
    Lake,
    add_partitions,
    changing,
    compact,
    manifest,
    read_catalog,
    read_days,
    read_dimension,
    read_lake,
    read_mark,
    read_summaries,
    read_transactions,
    refresh_summary,
    register_lake,
    vacuum,
    write_dimension,
    write_mark,
    write_transactions,
)
from tillroll.sources.shared import new_folder, stage
from tillroll.sources.tables import (
    TableSource,
    read_csv,
    read_csv_checked,
    read_star,
    read_table,
    write_csv,
)

__all__ = [
    "Lake",
    "TableSource",
    "add_partitions",
    "changing",
    "compact",
    "manifest",
    "new_folder",
    "read_catalog",
    "read_csv",
    "read_csv_checked",
    "read_days",
    "read_dimension",
    "read_lake",
    "read_mark",
    "read_star",
    "read_summaries",
    "read_table",
    "read_transactions",
    "refresh_summary",
    "register_lake",
    "stage",
    "vacuum",
    "write_csv",
    "write_dimension",
    "write_mark",
    "write_transactions",
]
