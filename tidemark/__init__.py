"""tidemark: feature, profiling, scoring and evaluation operators for PySpark.

Every operator takes and returns DataFrames; Catalyst and adaptive execution
pick the physical plan.
"""

__version__ = "0.1.0"
