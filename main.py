"""Entry point for ``spark-submit main.py``."""
import sys

from tidemark.plans.cli import main

if __name__ == "__main__":
    sys.exit(main())
