"""Column builders: path access on VARIANT records, predicates, value repair."""
