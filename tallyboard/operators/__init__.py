"""Relational steps shared by every plan: filter, count, align, total, warn."""
