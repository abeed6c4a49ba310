"""Column expressions: text cleaning, smoothing, naming rules."""
