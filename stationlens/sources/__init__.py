"""Readers and writers: feed (XML), raw (raw tables, loads, run log, seed), marts
(mart and fact sinks, versioned history)."""
