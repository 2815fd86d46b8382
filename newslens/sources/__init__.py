"""Inputs and outputs: feed lines, zip archives, manifests, serving tables, test fixtures."""
