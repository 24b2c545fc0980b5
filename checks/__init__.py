"""Driver-side checks: views over the given tables, registered queries, reference SQL."""
