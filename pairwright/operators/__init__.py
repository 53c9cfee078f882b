"""DataFrame operators: joins that stand skewed keys, ids, eligibility, features, outcomes, ranking."""
