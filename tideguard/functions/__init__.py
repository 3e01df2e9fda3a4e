"""Column expressions: text cleaning, label arithmetic, hashing, scoring."""
