"""DataFrame -> DataFrame operators (cleaning, labels, features, profiles,
reconciliation, sampling, evaluation, models)."""
