"""Operators for preparing training text (each in its own module, queries in ``queries``)."""
