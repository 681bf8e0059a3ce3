"""tidemark: analytics jobs written as PySpark DataFrame operators.

Each operator takes DataFrames (or columns) and gives DataFrames (or columns)
back; Catalyst and AQE decide how the work is carried out.
"""

__version__ = "0.1.0"
