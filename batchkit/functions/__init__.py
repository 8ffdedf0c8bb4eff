"""Scalar column functions. All are compositions of Spark built-ins, so they stay in generated code."""
