"""Structured Streaming: extensions beyond batch parity, and the since-token worker as an AvailableNow query."""
