"""Training-data operators: toxicity, near and substring dedup, decontamination, quality, tokens, packing, WARC, chat.

Nothing else in ``fleetlake`` imports this subpackage.
"""
