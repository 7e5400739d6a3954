"""Trip-mode analytics on Spark DataFrames: sessions, shown plans, clicks, profiles."""
