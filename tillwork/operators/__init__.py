"""Operator families; every function is ``DataFrame (+ parameters) -> DataFrame``."""
