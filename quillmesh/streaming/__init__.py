"""No streaming operators: every workload of this library is bounded.

All functions take and return batch DataFrames; see the README.
"""
