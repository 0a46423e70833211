"""Sources: catalog / Parquet scans, delimited text, JDBC, generator, fixture views."""

from sigscore.sources.delimited import (create_csv_table, load_csv_into_table,  # noqa: F401
                                        load_csv_partition, load_csv_quarantine,
                                        read_quarantine, scan_csv, scan_csv_strings,
                                        split_csv)
from sigscore.sources.generator import generate_signals  # noqa: F401
from sigscore.sources.inline import frame_from_rows  # noqa: F401
from sigscore.sources.jdbc import (jdbc_options, jdbc_scan, jdbc_scan_pruned,  # noqa: F401
                                   read_dimension)
from sigscore.sources.tables import parse_partition, scan_partition, scan_table  # noqa: F401
