"""Reading and writing log lines, rules, indicators and models."""
