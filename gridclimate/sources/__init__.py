"""Inputs and outputs: catalogue, site lists, landed responses, store, sinks."""
