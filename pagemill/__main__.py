"""`python -m pagemill`."""

from .cli import main

main()
