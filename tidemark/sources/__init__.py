"""Readers. All take an explicit schema; none infers one from data."""
