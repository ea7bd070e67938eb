"""End-to-end plans: discovery, topic pipeline, record pipeline, and the query catalogue."""
