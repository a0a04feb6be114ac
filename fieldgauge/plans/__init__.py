"""Runnable compositions: the daily job and the registered queries."""
