"""Operators for large-scale training-data pipelines, one module each.

Nothing else in the package imports this subpackage; its queries are registered by
``__spark_entry__.py`` when it can be imported.
"""
