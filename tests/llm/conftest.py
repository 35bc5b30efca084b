"""The session comes from the folder above."""
