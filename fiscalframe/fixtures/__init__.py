"""Receipt text, model answers and fetch logs rendered from the star-schema tables.

Every row of ``orders`` or ``lineitem`` becomes one receipt by itself, so the
rendering needs no join, grouping or shuffle and no receipt grows with the
number of rows that share a key.
"""
