"""Column builders: no function here runs a job or needs a Python UDF."""
