"""Column functions: identifiers, type coercion, dates and scores."""
