"""DataFrame operators: joins (interval, semi, anti), ordered windows, points, cleaning."""
