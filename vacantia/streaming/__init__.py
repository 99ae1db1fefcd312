"""The collection step on a stream of arriving files."""
