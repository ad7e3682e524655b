"""Supply-chain analytics on order data, written as lazy PySpark DataFrame functions."""

__version__ = "0.1.0"
