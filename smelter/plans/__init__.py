"""The jobs: bronze, silver, gold, marts, and the runner that puts them in order."""
