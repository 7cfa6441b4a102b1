"""Structured Streaming runners for the batch loop, the speed layer and stream scoring."""
