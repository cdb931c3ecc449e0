"""Operators that prepare training text: language, duplicates, leaks, sharding, packing, scoring.

Nothing else in the library imports this package. Each operator has a module; its query over
the benchmark tables stands at the end of that module and is listed in ``registry``.
"""
