"""rareclass.sources."""
