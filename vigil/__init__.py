"""Safety-event analytics on Spark.

Operators are plain functions from DataFrame to DataFrame, grouped by
family: ``vigil.functions`` (row-level rules), ``vigil.operators``
(aggregations, cubes, windows, validation, drift, corpora, clustering),
``vigil.sources`` (readers and writers) and ``vigil.streaming`` (live jobs).
``vigil.plans`` registers every operator as a named query over the test
tables; ``vigil.cli`` runs the batch jobs from the command line.
"""

__all__ = ["adapters", "constants", "schema", "session"]
