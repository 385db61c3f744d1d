"""Whole runs composed from operators: targets, master table, model, alerts."""
