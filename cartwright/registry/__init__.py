"""The models over TPC-H-like tables, and the same results in plain SQL."""
