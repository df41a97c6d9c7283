"""DataFrame-in, DataFrame-out operators of the forecasting model."""
