"""The datasets: bronze (ingested), silver (cleaned, summarised) and gold (reports)."""
