"""DataFrame operators: cleaning, features, profiles, evaluation, models, scoring."""
