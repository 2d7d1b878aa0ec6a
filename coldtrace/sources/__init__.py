"""Readers: messages, masters, load-test files, generated devices and telemetry."""
