"""Files in and out."""
