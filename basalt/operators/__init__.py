"""DataFrame → DataFrame operators, built from Spark SQL / MLlib built-ins."""
