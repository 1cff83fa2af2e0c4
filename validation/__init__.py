"""Checks against an independent SQL engine: raw datasets, one query per operator, one oracle per query."""
