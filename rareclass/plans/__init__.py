"""rareclass.plans."""
