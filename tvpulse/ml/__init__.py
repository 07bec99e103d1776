"""Device features, EDA, split, MLlib boosted trees, evaluation,
registry, TreeSHAP explanations, scoring and publishing."""
