"""DuckDB SQL that states, independently of Spark, what each query returns."""
