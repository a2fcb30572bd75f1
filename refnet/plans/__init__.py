"""Plans over the operators: balanced joins, the whole run, and the SQL surface."""
