"""rareclass: rare-class analytics on Spark DataFrames.

Profile and clean dirty tables, enrich them, build features, split exactly,
score rows with classifiers and anomaly detectors, and compute exact ranking
metrics.  Every operator takes and returns Spark DataFrames.
"""

__version__ = "0.1.0"
