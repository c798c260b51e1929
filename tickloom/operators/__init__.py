"""Operators that add metric columns to a frame of daily bars."""
