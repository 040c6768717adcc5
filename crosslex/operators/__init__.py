"""DataFrame operators: links, corpus, index, search, clauses, results, titles."""
