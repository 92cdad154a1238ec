"""Input relations, registered queries and their SQL twins."""
