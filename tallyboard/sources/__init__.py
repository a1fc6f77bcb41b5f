"""Datasets in: landing folder, catalog, column contracts and cleaning."""
