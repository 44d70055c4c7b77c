"""Completeness analytics for numbered event sequences, as Spark DataFrame operators.

Canonical frames (see ``gapwatch.names``): *received events*, one row per
delivery, and *registry*, the server-side rows that know each sequence's
segment. ``gapwatch.sources`` produces them, ``gapwatch.operators`` measures
them, ``gapwatch.plans`` composes whole runs and ``gapwatch.sinks`` writes them.
"""
