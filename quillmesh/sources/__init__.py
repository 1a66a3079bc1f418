"""Readers and writers: text files, keyed tables, delimited tables, matrices."""
