"""Relational building blocks shared by the plans (all DataFrame API)."""
