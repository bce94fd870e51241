"""Micro-batch forms of the batch plans."""
