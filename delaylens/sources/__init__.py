"""Readers for landing files and writers for tables and exports."""
