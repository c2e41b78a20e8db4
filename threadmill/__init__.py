"""threadmill: cleaning, filtering and restructuring of chat corpora on Spark DataFrames."""

__version__ = "0.1.0"
