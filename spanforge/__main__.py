"""python -m spanforge: see ``spanforge.plans.stages``."""

from spanforge.plans.stages import main

if __name__ == "__main__":
    main()
