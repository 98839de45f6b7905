"""Operators: DataFrame -> DataFrame transformations of the pipeline."""
