"""Whole jobs built from operators: manifest, selection, labelling, reports, validation."""
