"""Operators: DataFrames in, one DataFrame out, nothing run until the caller acts (the numbering
operator excepted, which writes its sorted input to the shared folder)."""
