"""The reference flows put together from operators."""
