"""cardmill: card-transaction feature engineering and fraud scoring as Spark jobs."""
