"""martloom: table, stream, mart and model operators written for Spark.

Everything is a plain function from columns to columns or from data frames
to data frames.  Sub-packages:

``sources``    readers and writers with explicit schemas
``functions``  column expressions
``operators``  joins, aggregates, windows, checks, hub/link/satellite loads
``plans``      ready-made marts composed of the operators
``streaming``  Structured Streaming jobs
``models``     statistics, preparation, training and scoring steps
``catalog``    every operator bound to the sample tables, with oracle SQL
"""

__version__ = "0.1.0"
