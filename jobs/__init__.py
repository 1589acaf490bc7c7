"""Runnable jobs over the library: each a function that takes a session, a command line and a settings file."""
