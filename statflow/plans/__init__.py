"""Recipes that need more than one pass, and the jobs made of operators."""
