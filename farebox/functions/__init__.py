"""Query modules; importing one registers its queries."""
