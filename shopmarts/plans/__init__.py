"""Plans: the twelve marts, the end-to-end pipeline, test-table mapping, query registry, SQL oracles."""
