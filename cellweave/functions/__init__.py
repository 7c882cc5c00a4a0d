"""Column builders: values, codes, geometry and seeded draws."""
