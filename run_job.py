"""Entry file for spark-submit; see ``tallygate.__main__`` for the jobs."""

from tallygate.__main__ import main

main()
