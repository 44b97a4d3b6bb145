"""Entry script for spark-submit; see ``orderlens/__main__.py`` for the jobs."""

from orderlens.__main__ import main

main()
