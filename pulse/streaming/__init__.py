"""The batch functions over streams."""
