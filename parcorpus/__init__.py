"""parcorpus: building, cleaning, aligning and preparing parallel text corpora
with Spark DataFrames.

Subpackages: ``functions`` (Column -> Column text functions), ``operators``
(DataFrame -> DataFrame operators), ``sources`` (readers, writers, dimension
builders), ``streaming`` (incremental ingest) and ``plans`` (the registered
queries over the test tables and their SQL oracle).
"""

__version__ = "0.1.0"
