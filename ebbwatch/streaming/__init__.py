"""Structured Streaming versions of the flow: silver, scores, activity windows, state and sinks."""
