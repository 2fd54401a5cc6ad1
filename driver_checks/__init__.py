"""The engine's own tables and operators, run on the driver's fixture tables."""
