"""statlake: regional statistics (wide CSV -> tidy facts -> analytic reads) on Spark."""

__version__ = "0.1.0"
