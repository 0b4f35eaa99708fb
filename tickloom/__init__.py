"""Market-event feature engine on Spark."""
