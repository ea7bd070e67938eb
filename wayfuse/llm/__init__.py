"""Operators for preparing training text.

Nothing outside this package imports it, and it imports nothing outside
itself; ``__spark_entry__`` adds its queries when it is present.
"""
