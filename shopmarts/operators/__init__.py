"""Operators: cleaning (C1-C20), integrity checks (S11-S15), global ranking."""
