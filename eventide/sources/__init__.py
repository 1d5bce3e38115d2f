from eventide.sources.files import csv_json_cells, csv_table, parquet_dir, parquet_table
from eventide.sources.jdbc import jdbc_table
from eventide.sources.memory import from_rows, sql_over
from eventide.sources.messages import decode_json, json_value_files, kafka_json

__all__ = ["csv_json_cells", "csv_table", "parquet_dir", "parquet_table", "jdbc_table", "from_rows",
           "sql_over", "decode_json", "json_value_files", "kafka_json"]
