"""DataFrame -> DataFrame operators: filters, trajectories, geodesy, fusion, analytics."""
