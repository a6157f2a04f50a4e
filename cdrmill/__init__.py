"""cdrmill: telecom usage, recharge, payment and revenue processing on Spark DataFrames."""

__version__ = "0.1.0"
