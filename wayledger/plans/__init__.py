"""Layer plans: normalised, typed and product tables, and the queries over them."""
