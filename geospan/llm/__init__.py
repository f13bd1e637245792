"""Operators for large-scale training-data pipelines.

Nothing else in geospan imports this subpackage; its queries are registered by
``queries.py`` when ``__spark_entry__`` can import it.
"""
