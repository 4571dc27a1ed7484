"""The layers: bronze, silver, gold, and the jobs that run them in order."""
