"""Column functions: titles, tokens, stop words, stemmers, analyzers."""
