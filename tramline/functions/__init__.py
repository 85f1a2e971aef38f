"""Column functions. All but the HTML helpers are native expressions."""
