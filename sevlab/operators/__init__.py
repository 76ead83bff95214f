"""DataFrame operators: cleaning, statistics, outliers, balance, sampling, features, model."""
