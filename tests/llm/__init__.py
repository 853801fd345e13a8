"""Tests of the training-text operators."""
