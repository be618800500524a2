"""Operators put together: recipes and the steps of a labelling job."""
