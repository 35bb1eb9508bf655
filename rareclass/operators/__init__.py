"""rareclass.operators."""
