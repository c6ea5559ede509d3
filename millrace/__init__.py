"""A change-data-capture table engine on Spark."""
