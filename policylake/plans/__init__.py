"""Whole tables, models and reports built from the functions and operators."""
