"""Script for `spark-submit`: the same command line as `python -m logweir`."""

from logweir.__main__ import main

if __name__ == "__main__":
    main()
