"""Training-data operators: token counts and files, near-dedup, decontamination,
PII pseudonyms, substring dedup, packing, web archives, quality rules and a
quality classifier.  Nothing outside this subpackage imports it."""
