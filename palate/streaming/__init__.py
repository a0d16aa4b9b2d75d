"""Feedback as a stream: intake, replay removal, latest ratings, windows, sessions."""
