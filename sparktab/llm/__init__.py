"""Operators for preparing training data at scale (thirteen operators, one module each).

Nothing outside this package imports it; ``__spark_entry__.py`` adds its queries
only when it can be imported.
"""
