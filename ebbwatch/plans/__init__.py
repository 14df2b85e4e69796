"""Whole jobs, the query catalogue and the SQL each query must agree with."""
