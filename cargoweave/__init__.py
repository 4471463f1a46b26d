"""Harmonises raw customs tables into one shipment layout, as Spark DataFrames."""
