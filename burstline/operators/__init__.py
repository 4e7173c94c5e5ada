"""DataFrame operators: terms, vocabulary, counts, bursts, entities, weights."""
