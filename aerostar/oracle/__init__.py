"""The jobs restated as DuckDB SQL, used as an independent correctness oracle."""
