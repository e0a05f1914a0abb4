"""tarmac: delay analytics on Spark.

Subpackages: ``sources`` (tables, streams, JSON events, result files),
``operators`` (counts, statistics, windows, cleaning, profiling, dedupe,
reports), ``functions`` (column helpers), ``sinks`` (per-batch and keyed
writers, JSON payloads), ``streaming`` (runners), ``ml`` (split, sampling,
pipeline, evaluation), ``plans`` (the registered queries over the driver
tables). ``flights`` and ``cli`` are the flight applications built on them.
"""

__version__ = "0.1.0"
