"""Cleaning profiles and the scoring plan."""
