"""Episodic time-series analytics on Spark: trajectories, poses, resampling, statistics, layouts."""
