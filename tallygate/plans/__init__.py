"""End-to-end jobs, the query registry and the SQL each query is checked against."""
