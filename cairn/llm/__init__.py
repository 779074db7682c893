"""Operators for training corpora: language, copies, extraction, scans, filters, tokens, shards."""
