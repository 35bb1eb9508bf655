"""rareclass.functions."""
