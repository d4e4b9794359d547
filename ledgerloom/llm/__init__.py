"""Operators for preparing training text, each usable alone; see ``queries``."""
