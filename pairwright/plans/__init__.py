"""Batch jobs: operators wired to the tables they read and write."""
