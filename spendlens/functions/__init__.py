"""Column helpers shared by the operators: guards, dates, text parsing, severity."""
