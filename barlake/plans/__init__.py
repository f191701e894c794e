"""Pipelines composed from the operators: bronze -> silver -> gold."""
