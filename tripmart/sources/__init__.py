"""Inputs: benchmark tables, seed tables, landing files and raw-file ingest."""
