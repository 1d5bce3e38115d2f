"""Schemas of the jobs' tables.

Fixed values: these column names and types must equal the reference jobs'
table declarations for the results to line up.
"""

# Fixed values -------------------------------------------------------------
# words: CSV / JDBC / CDC source of the word-count and mirror jobs.
WORDS = "id BIGINT, word STRING"
WORDS_JDBC = "id INT, word STRING"
WORDCOUNT = "word STRING, cnt BIGINT"
# user_action: click messages (name, sex, action, is_delete, ts).
USER_ACTION = "name STRING, sex STRING, action STRING, is_delete BIGINT, ts TIMESTAMP_NTZ"
# cluster_cpu_usage: metric messages.
CPU_USAGE = "cluster_name STRING, host_ip STRING, cpu_usage DOUBLE, ts TIMESTAMP_NTZ"
# input_table of the table-function job: a JSON array kept as text.
INPUT_TABLE = "id STRING, bs_info STRING"
BS_INFO_ITEM = ("bs3_name STRING, bs3_name_id INT, bs1_name_id INT, "
                "bs2_name_id INT, bs2_name STRING, bs1_name STRING")
BS_INFO = f"ARRAY<STRUCT<{BS_INFO_ITEM}>>"
BS_INFO_COLUMNS = ["bs3_name", "bs3_name_id", "bs1_name_id", "bs2_name_id", "bs2_name", "bs1_name"]
# Message time text and the event-time lateness bound of every stream job.
MESSAGE_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
WATERMARK_DELAY = "5 seconds"
# Change-record envelope (ours; the reference reads a database log directly).
CHANGE_RECORD = ("op STRING, seq BIGINT, before STRUCT<id: INT, word: STRING>, "
                 "after STRUCT<id: INT, word: STRING>")
# --------------------------------------------------------------------------
