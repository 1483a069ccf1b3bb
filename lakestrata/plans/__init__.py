"""The layers: bronze, silver, gold, their checks and the ordered run."""
