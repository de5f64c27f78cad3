"""Trait rarity for collections of tokens, computed on Spark."""

__version__ = "0.1.0"
