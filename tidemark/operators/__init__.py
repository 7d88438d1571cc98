"""DataFrame → DataFrame operators: normalisers, reports, snapshot comparison,
quality checks and dashboard marts."""
