"""``python -m wellspark --sf-dir ... --warehouse ...``: run every job in order."""

from .plans.jobs import main

if __name__ == "__main__":
    main()
