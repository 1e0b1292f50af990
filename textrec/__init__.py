"""textrec: turn catalogue items plus the text people write about them into
ranked recommendations, expressed with Spark DataFrames, built-in functions,
Spark ML and Structured Streaming."""

__version__ = "0.1.0"
