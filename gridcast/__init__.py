"""gridcast: hourly energy-market features, forecasting and model governance on Spark."""
