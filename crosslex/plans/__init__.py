"""Tables derived from the given data, the query registry and its check SQL."""
