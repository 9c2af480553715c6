"""Deciding what to read and which shape a job takes, before any data moves."""
