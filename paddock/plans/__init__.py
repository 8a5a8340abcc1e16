"""Reports and their plans: R0-R6, the point-model reports and the timing summaries."""
