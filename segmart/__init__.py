"""User-record cleaning, star-schema building and segment counting on Spark."""
