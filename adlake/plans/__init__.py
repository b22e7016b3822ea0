"""Declarative job specs that compose the operators."""
