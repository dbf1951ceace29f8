"""wardstar: hospital encounter analytics on Spark DataFrames.

Cleans encounter records, builds a star schema with stable keys, computes
readmission marts, integrity checks, profiles and type-2 history, flags
abnormal vitals with Structured Streaming, evaluates and trains a 30-day
readmission model with ``pyspark.ml`` and ranks vectors by similarity.
"""

__version__ = "0.1.0"
