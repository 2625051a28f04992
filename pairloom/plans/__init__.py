"""Assembled plans: the preparation job, the test inputs and the query catalog."""
