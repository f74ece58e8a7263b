"""Compositions: the ordered stages over tables, and the registered queries."""
