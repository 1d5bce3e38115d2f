from eventide.streaming.runtime import (StreamOptions, read_version, run_to_table, start_files,
                                        start_foreach_batch, use_rocksdb, versioned_fold)

__all__ = ["StreamOptions", "read_version", "run_to_table", "start_files", "start_foreach_batch",
           "use_rocksdb", "versioned_fold"]
