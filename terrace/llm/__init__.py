"""Training-data operators over the ``documents``, ``labels``, ``benchmark`` and ``conversations`` tables.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries when it is present.
"""
