"""Structured Streaming: stateful processors and query builders."""
