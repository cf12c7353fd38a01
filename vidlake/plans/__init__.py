"""Composed jobs (bronze->silver, silver->gold, features, recommendations,
ingestion) and the SQL-text entry point."""
