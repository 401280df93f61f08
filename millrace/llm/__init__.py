"""Operators of a large-scale training-data pipeline. Nothing else in millrace imports this subpackage."""
