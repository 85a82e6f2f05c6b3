"""Relational operators over conversations, calls, foods and logs."""
