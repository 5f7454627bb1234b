"""Training-data operators: packing, quality, toxicity, near duplicates,
fingerprints, page extraction, token counts, personal data, mixing and line
de-duplication. Nothing else in the library imports this subpackage."""
