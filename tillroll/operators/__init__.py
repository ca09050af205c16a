"""DataFrame operators: cleaning, orders, metrics, RFM, churn, cohorts, customer value."""
