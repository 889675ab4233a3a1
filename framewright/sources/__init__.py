"""Readers and writers of episodic datasets."""
