"""Inputs: change logs, entities, file listings."""
