"""Readers for raw observations, tables and seed lists."""
