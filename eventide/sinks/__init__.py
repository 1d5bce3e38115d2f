from eventide.sinks.files import csv_sink, kafka_sink, show, to_json_messages, write_json_messages
from eventide.sinks.jdbc import jdbc_execute, jdbc_query_value, jdbc_upsert, jdbc_write

__all__ = ["csv_sink", "kafka_sink", "show", "to_json_messages", "write_json_messages", "jdbc_execute",
           "jdbc_query_value", "jdbc_upsert", "jdbc_write"]
