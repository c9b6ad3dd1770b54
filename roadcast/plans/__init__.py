"""Jobs: feature and dataset assembly, training, scoring, serving, refresh."""
