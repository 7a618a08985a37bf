"""Operators for preparing training data; nothing else in the library imports them.

Every operator takes a DataFrame, finds its columns by name and leaves alone the
columns it does not know.  Driver-side work is bounded by parameters, never by rows.
"""
