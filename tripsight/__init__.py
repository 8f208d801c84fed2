"""tripsight: trip cleaning, features, profiles, models and scoring as Spark plans."""

__version__ = "0.1.0"
