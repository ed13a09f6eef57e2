"""The jobs: resolve players and teams, ingest player games and matches."""
