"""Prompts, providers and the round drivers of the generation pipelines."""
