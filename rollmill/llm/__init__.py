"""Operators for large text corpora: near duplicates, token counts, packing, pseudonyms, toxicity,
line runs, token files, decontamination, quality scores and rules. Nothing else in the library
imports this subpackage."""
