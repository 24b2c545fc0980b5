"""Whole jobs, from input tables to output table.  Some steps run Spark jobs while a plan is built: measured joins, checkpoints."""
