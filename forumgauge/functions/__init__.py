"""Column expressions and the keyword lexicons behind them."""
