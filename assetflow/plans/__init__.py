"""Named analytics built from the operators, and their DuckDB SQL twins."""
