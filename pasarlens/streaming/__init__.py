"""File-stream jobs and time-windowed alerts."""
