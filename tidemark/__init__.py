"""tidemark — market-risk analytics as Spark DataFrame transformations.

Layers:
    functions/  column expressions (coercion, guarded arithmetic, rounding, scorecards)
    sources/    raw landing, snapshot tables, report files
    operators/  normalisers, ranked reports, snapshot comparison, quality checks, marts
    plans/      the batch job and the table adapters used for verification
    streaming/  incremental normalisation of newly landed raw records
"""

__version__ = "0.1.0"
