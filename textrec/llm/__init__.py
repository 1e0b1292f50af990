"""Operators for preparing training data (token files, quality, licences,
near duplicates, tokenizer, decontamination, toxicity, PII, WARC).

Nothing else in the library imports this subpackage."""
