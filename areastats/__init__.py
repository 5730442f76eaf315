"""Neighbourhood indicators as Spark DataFrame plans."""
