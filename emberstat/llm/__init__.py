"""Operators for preparing training text: decontamination, licence scan, source
mixing, near-duplicate search, quality rules, token counts, page text,
sharding, URL rules, language identification, ranked search, periodic runs and
WARC archives.

Nothing else in the package imports this one.
"""
