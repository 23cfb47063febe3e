"""Table transformations: staging, rollups, dimensions and facts."""
