"""Column expressions: no Python UDFs, everything compiles into Catalyst."""
