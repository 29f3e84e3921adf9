"""Composite operators built from DataFrame primitives."""
