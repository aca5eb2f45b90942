"""Column builders: event model, parsing and casts, contract rules, lifecycle."""
