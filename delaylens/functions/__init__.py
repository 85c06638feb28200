"""Column-level helpers; everything here stays inside whole-stage codegen."""
