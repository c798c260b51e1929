"""Whole tables and the full batch run, composed from the operators."""
