"""Streaming: the reference is batch-only (no streams, watermarks or state).

The one streaming use is scoring: a fitted analysis is a set of DataFrame
expressions plus MLlib models, so it applies unchanged to a streaming
DataFrame (see ``score.py``).
"""
