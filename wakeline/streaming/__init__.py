"""Structured Streaming forms of the weekly roll-up and the drift check (K1-K3)."""
