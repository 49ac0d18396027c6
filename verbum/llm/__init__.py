"""Training-data operators: URL filters, decontamination, sharding, token
files, language-model scores, near-duplicates, packing, quality, document
fingerprints, line de-duplication, toxicity, importance resampling and hard
negatives.

Nothing else in the library imports this subpackage."""
