"""Training-data operators: quality, toxicity, near-duplicates, decontamination,
language identification, sharding, packing, line dedup, personal data, mixing, vector codes
and the audit of filters.

Nothing else in the package imports this subpackage.
"""
