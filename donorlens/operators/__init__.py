"""DataFrame operators: paid orders and the donor x month grid, RFM, cohort slots, churn, reshapes, key checks, keyed loads."""
