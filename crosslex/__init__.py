"""Cross-language retrieval over linked article collections, on Spark."""
