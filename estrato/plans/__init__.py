"""Layer plans: what each table of bronze, silver and gold is made of."""
