"""Registered queries over the driver tables, each with its SQL check where SQL can say it."""
