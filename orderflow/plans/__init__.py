"""Query plans: dashboards, layered runs, the named query registry."""
