"""Query plans: the 14 queries, the one-scan refresh, the registry and the oracle SQL."""
