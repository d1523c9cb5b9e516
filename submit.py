"""Script for spark-submit; ship the package with --py-files."""

from ridemetrics.job import main

main()
