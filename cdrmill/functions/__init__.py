"""Column expressions. All of them compile to built-in Spark functions."""
