"""Training-data operators: quality ranking, de-duplication, decontamination,
fingerprints, archives, tokenizing, extraction and sharding.

Nothing outside this subpackage imports it.
"""
