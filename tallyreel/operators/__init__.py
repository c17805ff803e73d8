"""Column-parameterized DataFrame operators. They take column names and know no domain."""
