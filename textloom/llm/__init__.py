"""Training-data operators: toxicity, token store, decontamination, repetition, archives, extraction, dedup, packing, sharding."""
