"""File packing, dataset layouts and the dataset registry."""
