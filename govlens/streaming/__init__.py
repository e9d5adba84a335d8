"""Structured Streaming adapter for the batch operators.

The reference is batch-only; this package only lets any ``DataFrame ->
DataFrame`` operator of the library run on each micro-batch of a file
stream (for example scoring newly arrived requests with a saved model).
"""
