"""Stateless routing of a message stream against a reply table."""
