"""The two domains, their end-to-end plans and the queries over the given tables."""
