"""Kernels over one key's ordered rows, each a small NumPy function run by Spark on grouped rows."""
