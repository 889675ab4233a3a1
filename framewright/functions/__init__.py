"""Column functions: rotations and poses, gripper signals, vectors, text."""
