"""Training-data operators (mixing, filters, token counts, deduplication, quality).

Nothing outside this subpackage imports it.
"""
