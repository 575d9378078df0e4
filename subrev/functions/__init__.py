"""Column-level building blocks: text, dates, numbers, cases, reasons, quantiles."""
