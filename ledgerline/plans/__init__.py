"""The jobs a user calls: decompose, ingest, refine, gold, profile, publish."""
