"""Evidence retrieval over page and post corpora on Spark: chunks, keyword and vector search, entities, claims and audits."""
