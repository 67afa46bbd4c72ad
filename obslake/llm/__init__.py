"""Training-data operators (deduplication, mixing, language, toxicity,
quality, search, formatting, packing, token files).  Nothing outside this
subpackage imports it."""
