"""Readers: capture field exports (tab / quoted CSV), staged tables, the packet view."""
