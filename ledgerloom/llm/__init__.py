"""Operators for large-scale training-data pipelines, each a plain function over DataFrames."""
