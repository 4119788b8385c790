"""Files in and out: raw CSV, staging, published tables, result CSV."""
