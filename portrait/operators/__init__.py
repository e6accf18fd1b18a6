"""DataFrame -> DataFrame operators (joins, profiles, scoring, metrics)."""
