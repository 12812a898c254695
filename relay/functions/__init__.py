"""Column functions: JSON values, predicates, path filters, status codes, keys."""
