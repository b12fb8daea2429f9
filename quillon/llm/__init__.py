"""Operators for preparing training text at scale; nothing else in quillon imports this package."""
