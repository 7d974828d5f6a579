"""Business-reporting jobs on Spark and the DataFrame operators beneath them."""
