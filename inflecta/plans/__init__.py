"""Whole jobs: building the dataset and answering queries over it."""
