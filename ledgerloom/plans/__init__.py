"""Composed plans: the feature pipeline and the train-score-save job."""
