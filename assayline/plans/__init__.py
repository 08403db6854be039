"""Datasets of the layers, as functions from frames to frames."""
