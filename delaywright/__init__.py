"""Flight-delay analytics as Spark jobs: sources, cleaning, features, splits, models, graphs."""

__version__ = "0.1.0"
