"""Training-data operators: near-duplicates, decontamination, licences, scores, tokens, shards."""
