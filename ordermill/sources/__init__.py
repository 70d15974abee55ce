"""Readers: order files, derived order feeds, topic envelopes."""
