"""Whole pipelines composed of operators: resolve, link, publish."""
