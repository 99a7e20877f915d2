"""Card-payment warehouse and fraud reporting on Spark DataFrames."""

__version__ = "0.1.0"
