"""Physical-shape helpers shared by the operators: size-checked broadcast, hot-cell salting,
skew-safe ranking within cells, lineage cuts. Everything is expressed with DataFrame
operations; Catalyst still plans every join and aggregate."""
