"""Operators that prepare training data: one module each, registered in ``queries``."""
