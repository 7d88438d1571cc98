"""Composed plans: the batch job, the registered queries and the test-table adapters."""
