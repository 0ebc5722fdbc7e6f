"""Structured Streaming: topic sources, scoring stream, sinks, fan-out and the
request/response correlation with a time limit (STR1-4, SNK2-6, JOIN4)."""
