"""Sinks: table writers and files."""

from sigscore.sinks.tables import (append, append_once, create_batched_table,  # noqa: F401
                                   create_table, drop_table, finish_swap, insert_values, overwrite_rows,
                                   read_csv_files, read_table, replace_partition, save_table,
                                   score_and_save, write_csv_files)
