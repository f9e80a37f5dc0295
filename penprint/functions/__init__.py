"""Column-level building blocks: tokens, features, rules, keys."""
