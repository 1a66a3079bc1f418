"""The user-facing pipelines."""
