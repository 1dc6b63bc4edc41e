"""Month and segment flows, and the queries over the given tables."""
