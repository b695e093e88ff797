"""Column functions: names, account ids, lenient coercion, text and dates."""
