"""Whole jobs: join strategies, the corpus pipeline and the training loops."""
