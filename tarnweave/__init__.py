"""Tarnweave: a PySpark-native engine for curating recorded demonstration episodes."""
