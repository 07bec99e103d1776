"""Composite plans: pipeline context, scope, semantic view, dashboards, build."""
