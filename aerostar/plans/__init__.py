"""The report jobs (A, M, V, D, N, R, S), the registered ETL jobs and their registration."""
