"""Compositions: the facade, the derived inputs and the query catalogue."""
