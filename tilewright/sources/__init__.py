"""Catalog tables, stored tiles, manifests and exports."""
