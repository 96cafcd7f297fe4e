"""Reports under their domain names: cleaning, batch tables, views over them."""
