"""End-to-end evaluations and the registered queries."""
