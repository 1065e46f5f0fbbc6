"""DataFrame operators: corpus, keyword, vectors, entities, claims, retrieval, policy and audits."""
