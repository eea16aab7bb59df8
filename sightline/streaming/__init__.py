"""Envelopes as a stream: the same course as a batch, with each batch's effect exactly once."""
