"""Steps put in order, and layers as jobs."""
