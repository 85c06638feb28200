"""Models composed from the operators: staging, the fact table, scoring."""
