"""Stages, checks and publication."""
