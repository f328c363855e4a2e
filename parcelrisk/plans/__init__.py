"""Composed plans: fixture views, query catalog, oracle SQL, jobs."""
