"""Measures per window of arrivals: completeness across boundaries, gap rate, copies, coverage, timing, drift, traffic.

Each reads the events once into rows that can be merged (bitmaps, counts,
sketches), so hours add up to days without reading events again.
"""
