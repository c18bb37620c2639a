"""Batch operators on feeds, states, dimensions, histories and secured tables."""
