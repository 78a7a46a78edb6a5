"""Dialogue-dataset preparation and evaluation as PySpark DataFrame operators."""
