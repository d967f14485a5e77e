"""tidelake: a lakehouse table toolkit written with the public Spark DataFrame, SQL and streaming APIs."""

__version__ = "0.1.0"
