"""Layer plans, registered queries and their SQL twins."""
