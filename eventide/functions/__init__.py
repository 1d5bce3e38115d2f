from eventide.functions.hashing import (HashCode, hash_code, hash_code_pandas, hash_code_udf,
                                        python_int_hash, register_sql_functions)

from eventide.functions.udfs import clock_text, scalar_function

__all__ = ["clock_text", "scalar_function", "HashCode", "hash_code", "hash_code_pandas", "hash_code_udf", "python_int_hash",
           "register_sql_functions"]
