"""Streaming.

The analyses this library re-expresses contain no stream, watermark, event-time
window or stateful operator, so no streaming operator is provided. The batch
operators are plain DataFrame transformations; the row-wise ones (cleaning,
casting, labelling, tokenising) also apply unchanged to a ``readStream`` frame.
"""
