"""Named queries (the registry behind ``__spark_entry__``) and their SQL oracles."""
