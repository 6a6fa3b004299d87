"""The driver's checks: survey tables derived from the given tables, one query per operator, and oracle SQL."""
