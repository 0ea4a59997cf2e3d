"""Composite jobs: features, training, scoring, requests and the daily chain."""
