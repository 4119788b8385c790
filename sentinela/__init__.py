"""Disease-notification surveillance analytics as DataFrame functions."""

__version__ = "0.1.0"
