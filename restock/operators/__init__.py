"""Table operators of the replenishment analytics, one module per stage."""
