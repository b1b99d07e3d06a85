"""DataFrame operators of the study engine."""
