"""Column-level functions: arrays, maps, structs, scalars, nulls."""
